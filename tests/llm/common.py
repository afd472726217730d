"""Awkward documents that every operator is run on."""

import random
import re
from collections import Counter

LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while many other animals look on from the far side of the river bank and wonder why anyone would ever bother to run so fast on a day as warm as this one was said to be by all"
NAMES = "doc_id long, text string, lang string, source string, n_chars long, node string, n int, prefix string, token string, key string, pos int, part int, kept_ int, row string, id string, `data` string, label string"


def awkward():
    words = PROSE.split()
    near = " ".join(words[:-1] + ["none"])
    texts = [PROSE, PROSE, near, PROSE.upper(), None, "", "   \n\t ", "one", "one two three", "ONE two\nthree", LONG, LONG + " tail", "\n\n", "a\x00b é 漢字 🙂", "line\nline\nline", "x " * 300]
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(0, PROSE, "en", "s0", len(PROSE)), (None, PROSE, None, None, None), (None, None, None, None, None), (90, "only here " * 30, None, None, None)]
    return [r + ("n", 1, "p", "t", "k", 2, 3, 4, "r", "i", "d", "l") for r in rows]


def table(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, NAMES)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def folded(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = words(folded(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(ids, sets):
    """Component's smallest id of each row, by comparing all rows."""
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and (sets[i] == sets[j] or 100 * (k := len(sets[i] & sets[j])) >= 75 * (len(sets[i]) + len(sets[j]) - k)):
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) if sets[i] else ids[i] for i in range(len(ids))]


def mutated(n_groups=12, copies=8, seed=5):
    """Texts with near copies around the threshold, chains among them, and passages that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    shared = [rng.choice(vocabulary) for _ in range(40)]
    out = []
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 120))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 18))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w = w + shared
            if rng.random() < 0.3:
                base = w
            out.append(" ".join(w))
    rng.shuffle(out)
    return out


def line_oracle(texts, min_docs=10):
    key = lambda x: folded(x.strip(" \t\n\v\f\r"))
    count = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    return [[x for x in (t or "").split("\n") if not (key(x) and count[key(x)] >= min_docs)] for t in texts]
