"""A modified Kneser-Ney model of code points, of order 5, for each language.

Symbols are code points as they are; a run of ASCII white space is one space, and
space stands before a text.  Grams run across words, so they hold the end of a word
with the beginning of the next.  Nothing bounds the alphabet or the grams: counts,
contexts and continuations of every order are tables that Spark counts and keeps
partitioned, and the model grows with the corpus.

Texts are dealt into two folds by the least hash of their grams, so equal texts
share one and near copies mostly do, and a text is scored by the counts of the
other fold: a text that nobody else repeats doesn't vouch for itself.

An entry of the model is a gram of up to 5 symbols that both folds have, with two
numbers a fold.  The log probability of a symbol is a sum over the grams that end
there, from none to five symbols: each adds its term, what it gives over the lower
order, and each context its weight, what it leaves to the lower order.  So entries
are looked up in any shards in any order.  They are stored by 64-bit hash in sorted
arrays, one for each of many ranges of the hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .arrow_text import MUL, SPACE, Texts, chunks, mix, trimmed
from .store import discard, stage

ORDER = 5
PAD = ORDER - 1
HELD_GRAMS = 400_000  # distinct grams that a map task adds up before it sends them
CHUNK = 1 << 20
SMALL = 100_000  # rows of a table that is broadcast in a join
BUCKET_ENTRIES = 100_000  # entries of a sorted array
ENTRY_BYTES = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(ORDER, _BASE), dtype=np.uint64)


class Symbols(NamedTuple):
    """The symbols of a run of texts with PAD spaces before each text, the place of each symbol, and of each text the number of symbols before it, with the total at the end."""

    codes: np.ndarray
    place: np.ndarray
    first: np.ndarray


def symbols(texts: Texts) -> Symbols:
    data = texts.data
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    at = heads[texts.offsets]
    space = (code < 128) & SPACE[np.minimum(code, 255)]
    before = np.zeros(len(code), bool)
    before[1:] = space[:-1]
    starts = at[:-1]
    before[starts[starts < len(code)]] = True  # a text's leading white space joins the space that stands before it
    keep = ~(space & before)
    total = np.zeros(len(code) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    first = total[at]
    clean = np.where(space, 32, np.where(code == 0, 0xFFFD, code))[keep]
    place = np.arange(len(clean)) + PAD * (np.repeat(np.arange(len(texts)), np.diff(first)) + 1)
    codes = np.full(len(clean) + PAD * len(texts), 32, np.uint64)
    codes[place] = clean
    return Symbols(codes, place, first)


def gram_hash(codes: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` symbols that end at each place."""
    h = np.full(len(place), (size * int(MUL)) % (1 << 64), np.uint64)
    for k in range(size):
        h += (codes[place - k] + np.uint64(1)) * _POWERS[k]
    return h


def gram_hashes(codes: np.ndarray, place: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """gram_hash of 0 to ``most`` symbols."""
    h = np.zeros(len(place), np.uint64)
    for size in range(most + 1):
        if size:
            h = h + (codes[place - size + 1] + np.uint64(1)) * _POWERS[size - 1]
        yield h + np.uint64((size * int(MUL)) % (1 << 64))


def salt(lang: str) -> int:
    return xxh3_64_intdigest(lang)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the first place of each, and of each place the number of its hash.

    What np.unique gives, by one sort of plain integers: the top bits of a hash over
    its place.  Hashes that share those bits and differ are sorted in full.
    """
    n = len(h)
    if not n:
        return h, np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    packed = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    at = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(n, bool)
    np.not_equal(packed[1:] >> bits, packed[:-1] >> bits, out=new[1:])
    ordered = h[at]
    if (new[1:] != (ordered[1:] != ordered[:-1])).any():
        return np.unique(h, return_index=True, return_inverse=True)
    number = np.empty(n, np.int64)
    number[at] = np.cumsum(new) - 1
    return ordered[new], at[new], number


def _unique(sym: Symbols, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct grams of the highest order and languages: their hashes, the first symbol each ends at, and of each symbol the gram that ends there."""
    return distinct(mix(gram_hash(sym.codes, sym.place, ORDER) + np.repeat(salts, np.diff(sym.first))))


def folds(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text 0 or 1, by the least hash of its grams."""
    n = np.diff(first)
    out = np.zeros(len(n), np.int64)
    if len(hashes):
        out[n > 0] = (mix(np.minimum.reduceat(hashes, first[:-1][n > 0])) & np.uint64(1)).astype(np.int64)
    return out


def counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, g, a, b) of (lang, text): how often each gram of ORDER symbols ends at a symbol in either fold, over all documents."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple] = []
        size = 0

        def merged() -> list[tuple]:
            key, lang, a, b, grams = (np.concatenate([p[k] for p in held]) for k in range(5))
            _, index, at = distinct(key)
            return [(key[index], lang[index], np.bincount(at, a, len(index)), np.bincount(at, b, len(index)), grams[index])]

        def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            word = pa.array(list(names), pa.string())
            for _, lang, a, b, grams in parts:
                for k in range(0, len(a), 50_000):
                    i = slice(k, k + 50_000)
                    text = np.ascontiguousarray(grams[i]).view(f"<U{ORDER}").ravel().tolist()
                    yield pa.RecordBatch.from_arrays([word.take(pa.array(lang[i])), pa.array(text, pa.string()), pa.array(a[i].astype(np.int64)), pa.array(b[i].astype(np.int64))], ["lang", "g", "a", "b"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for texts in chunks(batch.column(1), CHUNK):
                here = langs[texts.first : texts.first + len(texts)]
                sym = symbols(texts)
                if not len(sym.place):
                    continue
                number = np.array([names.setdefault(x, len(names)) for x in here], np.int32)
                keys, index, at = _unique(sym, np.array([salt(x) for x in here], np.uint64))
                fold = np.repeat(folds(keys[at], sym.first), np.diff(sym.first))
                b = np.bincount(at, fold, len(keys))
                end = sym.place[index]
                grams = np.stack([sym.codes[end - k] for k in range(PAD, -1, -1)], 1).astype("<u4")
                held.append((keys, np.repeat(number, np.diff(sym.first))[index], np.bincount(at, minlength=len(keys)) - b, b, grams))
                size += len(keys)
                if size >= 2 * HELD_GRAMS:
                    held[:] = merged()
                    size = len(held[0][0])
                    if size >= HELD_GRAMS:
                        yield from flush(held)
                        held, size = [], 0
        if held:
            yield from flush(merged())

    rows = docs.mapInArrow(run, "lang string, g string, a long, b long")
    return rows.groupBy("lang", "g").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _discounts(x: str) -> list[Column]:
    """Chen and Goodman's D1, D2, D3+ from the counts of counts, each within (0, count)."""
    y = F.when(F.col(f"{x}1") > 0, F.col(f"{x}1") / (F.col(f"{x}1") + 2 * F.col(f"{x}2"))).otherwise(0.5)
    d = [F.when(F.col(f"{x}{k}") > 0, k - (k + 1) * y * F.col(f"{x}{k + 1}") / F.col(f"{x}{k}")).otherwise(0.5 * k) for k in (1, 2, 3)]
    return [F.greatest(F.lit(0.05 * k), F.least(F.lit(0.95 * k), v)).alias(f"d{x}{k}") for k, v in enumerate(d, 1)]


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL else df


def entries(docs: DataFrame) -> DataFrame:
    """Rows (lang, g, ta, tb, wa, wb) of (lang, text): terms and weights of grams of up to 5 symbols by the counts of either fold.

    The lower orders count, as Kneser and Ney do, how many symbols a gram follows.
    The gram of no symbols has the weight that the uniform distribution gets, times
    its probability.  Only grams that both folds have are needed, as a text of one
    fold asks for the numbers of the other; a language's gram of no symbols is there
    always.
    """
    per_fold = lambda f: [e for x in "ab" for e in f(x)]
    tables = {ORDER: stage(counts(docs), f"grams-{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        lower = tables[k + 1].groupBy("lang", F.substring("g", 2, k).alias("g")).agg(*[F.count_if(F.col(x) > 0).alias(x) for x in "ab"])
        tables[k] = stage(lower, f"grams-{k}")
    every = None
    for k, t in tables.items():
        t = t.select("lang", F.lit(k).alias("k"), F.substring("g", 1, k - 1).alias("h"), "a", "b")
        every = t if every is None else every.union(t)
    kinds = every.groupBy("lang", "k").agg(*per_fold(lambda x: [F.count_if(F.col(x) == n).cast("double").alias(f"{x}{n}") for n in (1, 2, 3, 4)]), F.count("*").alias("grams"))
    d = stage(kinds.select("lang", "k", (-F.log(F.col("grams") + 1.0)).alias("uniform"), *per_fold(_discounts)), "discounts")
    small = _small(d)
    context = every.groupBy("lang", "k", "h").agg(*per_fold(lambda x: [F.sum(x).alias(f"t{x}"), *[F.count_if((F.col(x) == n) if n < 3 else (F.col(x) >= 3)).alias(f"{x}_{n}") for n in (1, 2, 3)]]))
    gamma = lambda x: F.when(F.col(f"t{x}") > 0, sum(F.col(f"d{x}{n}") * F.col(f"{x}_{n}") for n in (1, 2, 3)) / F.col(f"t{x}")).otherwise(1.0)
    context = context.where("k = 1 or ta > 0 and tb > 0").join(small, ["lang", "k"])
    context = stage(context.select("lang", "k", "h", "ta", "tb", "uniform", *[gamma(x).alias(f"y{x}") for x in "ab"]), "contexts")
    zero = F.lit(0.0)
    found = context.select("lang", F.col("h").alias("g"), zero.alias("ta"), zero.alias("tb"), *[(F.log(f"y{x}") + F.when(F.col("k") == 1, F.col("uniform")).otherwise(0.0)).alias(f"w{x}") for x in "ab"])
    below, made = None, [d, context]
    for k in range(1, ORDER + 1):
        shared = tables[k].where("a > 0 and b > 0").withColumn("h", F.substring("g", 1, k - 1))
        shared = shared.join(small.where(F.col("k") == k).drop("k", "uniform"), "lang").join(_small(context.where(F.col("k") == k).drop("k")), ["lang", "h"])
        if below is None:
            shared = shared.select("*", *[F.exp("uniform").alias(f"q{x}") for x in "ab"])
        else:
            shared = shared.withColumn("s", F.substring("g", 2, k - 1)).join(_small(below), ["lang", "s"])
        share = lambda x: (F.col(x) - F.when(F.col(x) >= 3, F.col(f"d{x}3")).when(F.col(x) == 2, F.col(f"d{x}2")).otherwise(F.col(f"d{x}1"))) / F.col(f"t{x}")
        rest = lambda x: F.col(f"y{x}") * F.col(f"q{x}")
        p = stage(shared.select("lang", "g", *[(share(x) + rest(x)).alias(f"p{x}") for x in "ab"], *[F.log1p(share(x) / rest(x)).alias(f"t{x}") for x in "ab"]), f"probabilities-{k}")
        made.append(p)
        below = p.select("lang", F.col("g").alias("s"), F.col("pa").alias("qa"), F.col("pb").alias("qb"))
        found = found.union(p.select("lang", "g", "ta", "tb", zero.alias("wa"), zero.alias("wb")))
    out = stage(found.groupBy("lang", "g").agg(*[F.sum(c).cast("float").alias(c) for c in ("ta", "tb", "wa", "wb")]), "gram-entries")
    for used in (*tables.values(), *made):
        discard(used)
    return out


def _keyed(bits: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, which = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            salts = np.array([salt(x) for x in names], np.uint64)[which] if len(which) else np.zeros(0, np.uint64)
            text = np.array(batch.column(1).to_pylist(), f"<U{ORDER}")
            codes = text.view("<u4").reshape(len(text), ORDER).astype(np.uint64)
            size = (codes != 0).sum(1)
            key = np.zeros(len(text), np.uint64)
            for n in range(ORDER + 1):
                rows = np.flatnonzero(size == n)
                key[rows] = entry_key(gram_hash(codes[rows].ravel(), ORDER * np.arange(len(rows)) + n - 1, n), salts[rows])
            bucket = (key >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(key), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(key.view(np.int64)), *batch.columns[2:]], ["bucket", "key", "ta", "tb", "wa", "wb"])

    return run


def entry_key(h: np.ndarray, salts: np.ndarray) -> np.ndarray:
    return mix(h + salts)


def _sorted(key: tuple, rows: pa.Table) -> pa.Table:
    keys = rows.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    out = {"bucket": [key[0].as_py()], "keys": [keys[order].tobytes()]}
    out |= {c: [rows.column(c).to_numpy()[order].astype("<f4").tobytes()] for c in ("ta", "tb", "wa", "wb")}
    return pa.table(out, schema=pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), *((c, pa.binary()) for c in ("ta", "tb", "wa", "wb"))]))


def arrays(found: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows (bucket, keys, ta, tb, wa, wb): the entries in sorted arrays, one for each range of the hash; their number, and that of the ranges."""
    n = found.count()
    bits = max(0, (n // BUCKET_ENTRIES).bit_length())
    rows = found.select("lang", "g", "ta", "tb", "wa", "wb").mapInArrow(_keyed(bits), "bucket int, key long, ta float, tb float, wa float, wb float")
    return stage(rows.groupBy("bucket").applyInArrow(_sorted, "bucket int, keys binary, ta binary, tb binary, wa binary, wb binary"), "gram-model"), n, 1 << bits


class Shard:
    """Entries of consecutive ranges in arrays sorted by hash."""

    def __init__(self, rows: list[tuple]):
        join = lambda k, kind: np.frombuffer(b"".join(r[k] for r in sorted(rows)), kind)
        self.keys = join(1, np.uint64)
        self.term = [join(2, "<f4"), join(3, "<f4")]
        self.weight = [join(4, "<f4"), join(5, "<f4")]
        # hashes are spread evenly, so their top bits lead to within a few entries of a hash
        self.shift = np.uint64(63 - max(1, len(self.keys)).bit_length())
        self.first = np.searchsorted(self.keys >> self.shift, np.arange((1 << int(np.uint64(64) - self.shift)) + 1, dtype=np.uint64)).astype(np.int32)

    def _add(self, keys: np.ndarray, out: list[np.ndarray]) -> None:
        if not len(self.keys):
            return
        top = keys >> self.shift
        at, end = self.first[top], self.first[top + np.uint64(1)]
        rows = np.flatnonzero(at < end)
        while len(rows):
            same = self.keys[at[rows]] == keys[rows]
            hit = rows[same]
            for x in (0, 1):
                out[x][hit] += self.term[x][at[hit]]
                out[2 + x][hit] += self.weight[x][at[hit]]
            at[rows] += 1
            rows = rows[~same]
            rows = rows[at[rows] < end[rows]]

    def log_probabilities(self, texts: Texts, langs: list[str]) -> np.ndarray:
        """What these entries add to the log probability of each text; all shards together give it."""
        out = np.zeros(len(texts))
        sym = symbols(texts)
        if not len(sym.place):
            return out
        salts = np.array([salt(x) for x in langs], np.uint64)
        n = np.diff(sym.first)
        keys, index, at = _unique(sym, salts)
        fold = folds(keys[at], sym.first)
        own, end = np.repeat(salts, n)[index], sym.place[index]
        per = [np.zeros(len(keys)) for _ in range(4)]
        for h in gram_hashes(sym.codes, end, ORDER):
            self._add(entry_key(h, own), per)
        # the space before a text is a context and no symbol
        spaces = np.full(PAD, 32, np.uint64)
        names, which = np.unique(salts, return_inverse=True)
        start = [np.zeros(len(names)) for _ in range(4)]
        for size in range(ORDER):
            self._add(entry_key(gram_hash(spaces, np.full(len(names), PAD - 1), size), names), start)
        some = n > 0
        for x in (0, 1):
            term, weight = per[1 - x][at], per[3 - x][at]  # a text of one fold by the counts of the other
            sums = np.concatenate([[0.0], np.cumsum(term + weight)])
            total = sums[sym.first[1:]] - sums[sym.first[:-1]]
            last = np.zeros(len(texts))
            last[some] = weight[sym.first[1:][some] - 1]
            out = np.where(some & (fold == x), total - last + start[3 - x][which], out)
        return out
