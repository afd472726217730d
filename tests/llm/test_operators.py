"""Every operator against brute force, on awkward and on empty tables."""

import hashlib
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from borderloom.llm.arrow_text import chunks
from borderloom.llm import bpe, chroma, components, gam, gram_model, html_text, lines, ngram_join, packing, quality_rules, quotes, warc

from .common import awkward, components as brute_components, line_oracle, mutated, shingles, table, words

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def key(rows):
    return Counter(map(str, rows))


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


# components


def test_components(spark):
    rng = np.random.default_rng(3)
    e = rng.integers(0, 400, (330, 2))
    e[:60, 0] = 7  # a star
    e[100:160] = np.stack([np.arange(1000, 1060), np.arange(1001, 1061)], 1)  # a chain
    got = {r.node: r.root for r in components.components(spark.createDataFrame(e.tolist(), "a long, b long"), "a", "b").collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in e.tolist():
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    alone = {x for x in parent} - {x for a, b in e.tolist() if a != b for x in (a, b)}
    assert got == {x: find(x) for x in parent if x not in alone}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# 4


@pytest.mark.parametrize("block", [ngram_join.BLOCK_TOKENS, 60])
def test_join_brute(spark, block):
    texts = mutated() + ["a b c", "a b c", "A b C", "a b", "", None]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block_tokens=block).collect()}
    sets = [shingles(t) for t in texts]
    want = brute_components([i for i, _ in rows], sets)
    assert got == {i: (len(sets[i]), want[i]) for i, _ in rows}
    assert len({c for _, c in got.values()}) < len(rows) - 20


def test_join_awkward(spark, docs, none):
    got = key((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs).collect())
    rows = awkward()
    sets = [shingles(r[1]) for r in rows]
    assert got == key((r[0], len(s), c) for r, s, c in zip(rows, sets, brute_components([r[0] for r in rows], sets)))
    assert ngram_join.ngram_jaccard_join(none).collect() == []


def test_drop_near_duplicates(spark, docs, none):
    got = ngram_join.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    rows = awkward()
    sets = [frozenset(shingles(r[1])) for r in rows]
    comp = brute_components(list(range(len(rows))), sets)
    assert got.count() == len(set(comp))
    assert ngram_join.drop_near_duplicates(none).count() == 0
    unique = spark.createDataFrame([(i, t) for i, t in enumerate(mutated())], "doc_id long, text string")
    kept = {r.doc_id for r in ngram_join.drop_near_duplicates(unique).collect()}
    assert kept == set(brute_components(list(range(unique.count())), [shingles(r.text) for r in unique.orderBy("doc_id").collect()]))


# 8


def test_lines(spark, docs, none):
    texts = [f"head\n Common LINE \nown {i}\n\ncommon line" + ("\nnine" if i < 9 else "") for i in range(12)] + [None, "", "common line", "\n", "common line"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, _drop int")
    want = line_oracle(texts)
    for limit in (lines.FREQUENT, 0):
        got = {r.doc_id: r for r in lines.drop_frequent_lines(df, broadcast_at_most=limit).collect()}
        for i, t in enumerate(texts):
            n = len((t or "").split("\n"))
            assert (got[i].text, got[i].n_lines, got[i].n_dropped) == ("\n".join(want[i]), n, n - len(want[i]))
        out = lines.drop_frequent_lines(docs, min_docs=3, broadcast_at_most=limit)
        assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
        rows = awkward()
        kept = line_oracle([r[1] for r in rows], 3)
        assert key((r.doc_id, r.text) for r in out.collect()) == key((r[0], "\n".join(k)) for r, k in zip(rows, kept))
        assert lines.drop_frequent_lines(none, broadcast_at_most=limit).count() == 0


# 10


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCAB)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe(docs, none, library):
    got = key((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(docs, VOCAB).collect())
    want = []
    for r in awkward():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert got == key(want)
    assert bpe.encode_digests(none, VOCAB).count() == 0


def test_bpe_random(library):
    import random

    rng = random.Random(1)
    own, fast = bpe.ByteBPE(bpe.read_vocabulary(VOCAB)), packing.RankEncoder(bpe.read_vocabulary(VOCAB))
    letters = "ab  \n\t 　\x1c'sreveé漢🙂1 2.!"
    for _ in range(4000):
        s = "".join(rng.choice([*letters, "<|endoftext|>", "<|end"]) for _ in range(rng.randint(0, 25)))
        ids = library.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(s), "<u4").tolist() == ids, s
        assert fast.encode(s) == own.encode(s), s
        assert own.decode(own.encode(s)) == library.decode(ids, skip_special_tokens=False)


# 9


def check_pieces(rows, pieces, library):
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append(p)
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        at = 0
        for p in seq:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048 and seq[0].window == (at if at & (at - 1) == 0 else 2048)
    want, got = Counter(), Counter()
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[i] += len(ids)
        for p in (p for p in pieces if p.doc_id == i):
            if p.doc_tokens == len(ids):
                assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 or [j for j, _ in rows].count(i) > 1
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want
    return by_seq


@pytest.mark.parametrize("group", [packing.GROUP, 5])
def test_packing(docs, none, library, group):
    pieces = packing.pack_documents(docs, VOCAB, group=group).collect()
    check_pieces([(r[0], r[1]) for r in awkward()], pieces, library)
    assert packing.pack_documents(none, VOCAB).count() == 0


def test_packing_little_padding(spark, library):
    rows = [(i, t) for i, t in enumerate(mutated(30, 10))]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), VOCAB).collect()
    seqs = check_pieces(rows, pieces, library)
    padding = sum(s[0].window - sum(p.length for p in s) for s in seqs.values())
    assert padding < 2048 and len(pieces) < 1.5 * len(rows)


def test_pack_any_lengths():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 300):
        lengths = rng.integers(0, 2048, n).tolist()
        seqs = packing.pack(lengths)
        held = Counter()
        for s in seqs:
            for k, _, m in s:
                held[k] += m
        assert all(held[k] == m for k, m in enumerate(lengths))
        assert sum((t := sum(m for _, _, m in s)) & (t - 1) != 0 for s in seqs) <= 1


# 7


def base_counts(t):
    w = words(t)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    found = [x for x in (t or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(found) - len(set(found)), len(again)


def test_quality_rules(docs, none):
    got = quality_rules.quality_rules(docs).collect()
    assert key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == key((r[0], *base_counts(r[1])) for r in awkward())
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.quality_rules(none).count() == 0


def brute_kneser_ney(texts):
    """Log probability of each text by the grams of the other fold, straight from the definition."""
    import math
    import re

    order = gram_model.ORDER
    rows = [re.sub("[\\x20\\x09-\\x0D]+", " ", " " + (t or "")).replace("\x00", "\ufffd")[1:] for t in texts]
    fold = []
    for t in texts:
        chunk = next(chunks(pa.array([t or ""])))
        sym = gram_model.symbols(chunk)
        keys, _, at = gram_model._unique(sym, np.array([gram_model.salt("xx")], np.uint64))
        fold.append(int(gram_model.folds(keys[at], sym.first)[0]))
    padded = [" " * (order - 1) + r for r in rows]
    alphabet = len({c for r in rows for c in r})
    models = []
    for f in (0, 1):
        tables = {order: Counter(p[i : i + order] for p, k in zip(padded, fold) if k == f for i in range(len(p) - order + 1))}
        for k in range(order - 1, 0, -1):
            tables[k] = Counter(g[1:] for g in tables[k + 1])
        d = {}
        for k, t in tables.items():
            n = [0] + [sum(v == j for v in t.values()) for j in (1, 2, 3, 4)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            d[k] = [0] + [min(max(j - (j + 1) * y * n[j + 1] / n[j] if n[j] else 0.5 * j, 0.05 * j), 0.95 * j) for j in (1, 2, 3)]
        after = {}
        for t in tables.values():
            for g, v in t.items():
                after.setdefault(g[:-1], []).append((len(g), v))
        models.append((tables, d, after))

    def p(model, h, c):
        tables, d, after = model
        k = len(h) + 1
        low = p(model, h[1:], c) if h else 1 / (alphabet + 1)
        if h not in after:
            return low
        total = sum(v for _, v in after[h])
        gamma = sum(d[k][min(v, 3)] for _, v in after[h]) / total
        v = tables[k].get(h + c, 0)
        return (v - d[k][min(v, 3)]) / total + gamma * low

    return [sum(math.log(p(models[1 - f], t[i - order + 1 : i], t[i])) for i in range(order - 1, len(t))) for t, f in zip(padded, fold)]


def test_perplexity_model(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdé漢 "), rng.integers(1, 6))) for _ in range(30)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 25))) for _ in range(60)] + ["", None, "  lead\n\nand  trail ", "a\x00b 🙂", "zzz"]
    want = brute_kneser_ney(texts)
    df = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.score(spark, df, "lang", "text").collect()}
    for i, t in enumerate(texts):
        lexical = sum(any(c.isascii() and c.isalnum() or ord(c) >= 0x80 for c in w) for w in words(t))
        assert (got[i].log_perplexity is None) if not lexical else abs(got[i].log_perplexity + want[i] / lexical) < 1e-4
    assert len({round(x, 3) for x in want}) > 50


def test_counts_add_up(spark, monkeypatch):
    texts = ["the cat sat on the mat", "a dog sat", "", None, "CATS 12!", "the cat sat on the mat"]
    df = spark.createDataFrame([("en", t) for t in texts] + [("de", "a dog sat")], "lang string, text string")
    rows = gram_model.counts(df).collect()
    grams = lambda lang, t: Counter((lang, p[i : i + gram_model.ORDER]) for p in [" " * gram_model.PAD + (t or "")] for i in range(len(p) - gram_model.PAD))
    want = sum((grams("en", t) for t in texts), grams("de", "a dog sat"))
    assert {(r.lang, r.g): r.a + r.b for r in rows} == dict(want)
    monkeypatch.setattr(gram_model, "HELD_GRAMS", 3)
    assert key(rows) == key(gram_model.counts(df).collect())


def test_bands_reject(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 8))) for _ in range(500)]
    prose = lambda: " ".join(rng.choice(vocabulary, 120))
    rows = [(i, prose(), "en") for i in range(300)] + [(900, " ".join(w + "%$#" for w in prose().split()), "en"), (901, prose().replace(" ", " | "), "en")]
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[900] and not got[901] and sum(got[i] for i in range(300)) >= 298


def test_shards_add_up(spark, docs, monkeypatch):
    got = lambda: key(quality_rules.quality_rules(docs).select("doc_id", "kept", F.round("log_perplexity", 4)).collect())
    whole = got()
    monkeypatch.setattr(quality_rules, "SHARD_ENTRIES", 500)
    monkeypatch.setattr(gram_model, "BUCKET_ENTRIES", 100)
    assert got() == whole
    monkeypatch.setattr(quality_rules, "BROADCAST_TEXTS", 0)
    monkeypatch.setattr(gram_model, "SMALL", 0)
    assert got() == whole


def test_quality_rules_names(spark, docs):
    """Columns that clash with inner names, and other spellings of the given ones."""
    odd = docs.withColumnRenamed("lang", "Lang").withColumnRenamed("text", "Text").withColumn("_key", F.lit(1)).withColumn("_l", F.lit(2)).withColumn("a b", F.lit(3)).withColumn("bucket", F.lit(4))
    got = quality_rules.quality_rules(odd)
    assert set(odd.columns) <= set(got.columns)
    assert key((r.doc_id, r.kept) for r in got.collect()) == key((r.doc_id, r.kept) for r in quality_rules.quality_rules(docs).collect())


def test_gibberish_of_any_script(spark):
    rng = np.random.default_rng(7)
    for letters in ("абвгдежзиклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"):
        vocabulary = ["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(400)]
        rows = [(i, " ".join(rng.choice(vocabulary, 150)), "xx") for i in range(200)]
        rows += [(900 + i, " ".join("".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(150)), "xx") for i in range(5)]
        got = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
        assert not any(got[900 + i] for i in range(5)) and sum(got[i] for i in range(200)) >= 196


# 5


def test_gam_learns_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    m = gam.fit(x[:3000], y[:3000])
    assert (0, 3) in m.pairs
    assert ((m.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert gam.fit(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def test_classifier(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = gam.quality_classifier(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").toPandas()
    assert len(got) > 40 and (got.predicted == got.quality).mean() > 0.95
    both = {r.doc_id: round(r.score, 9) for r in gam.quality_scores(docs, labels).collect()}
    assert both == {r.doc_id: round(r.score, 9) for r in gam.quality_classifier(docs, labels).collect()}


def test_classifier_awkward(spark, docs, none):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (None, 1), (3, None), (5, 7), (2, 1)], "doc_id long, quality int")
    got = gam.quality_classifier(docs, labels)
    assert got.columns == [*docs.columns, "score", "predicted", "held_out"]
    rows = got.collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert gam.quality_classifier(none, labels).count() == 0
    nothing = gam.quality_classifier(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}


# 2


def archive(spark, pages, tmp_path, **options):
    path = f"{tmp_path}/warc"
    warc.write_archive(pages, path, **options)
    return path


def test_warc(spark, tmp_path):
    import base64

    html = [None, "", "<p>a</p>", "<p>a</p>", "é漢🙂" * 50, "é漢🙂" * 50, "x\r\n\r\ny", "<p>a</p>", "z" * 200_000]
    rows = [(i, f"http://h/{i}" if i % 3 else None, h, "r") for i, h in enumerate(reversed(html))] + [(None, "u\r\nWARC-Type: x", "<p>a</p>", "r"), (50, "http://a\u0085WARC-Refers-To: <urn:page:9>", "only this", "r"), (51, "http://a\u2028b\u2029c", "and this", "r"), (2, "again", "z" * 10, "r"), (2, "again", "z" * 10, "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    for least in (0, 8, 1 << 30):
        path = archive(spark, pages, tmp_path / str(least), min_bytes=least)
        got = warc.parse_records(warc.read_archive(spark, path)).collect()
        want, seen = [], {}
        for i, u, h, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
            b = (h or "").encode()
            first = seen.setdefault(b, i) if len(b) >= least else i
            again = len(b) >= least and (b, "seen") in seen
            seen[(b, "seen")] = True
            want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first if again else None))
        assert key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == key(want)
        assert all(r.digest_ok for r in got)
        assert {r.url for r in got if r.page_id in (50, 51)} == {"http://a\u0085WARC-Refers-To: <urn:page:9>", "http://a\u2028b\u2029c"}
        stored = spark.read.parquet(f"{path}/payloads")
        assert stored.count() == len({(r[2] or "") for r in rows})
    record = next(r for r in warc.read_archive(spark, path).collect() if b"<urn:page:0>" in bytes(r.record))
    head, http, rest = bytes(record.record).split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest == b"z" * 200_000 + b"\r\n\r\n"
    length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b": ")[1])
    assert length == len(http) + 4 + 200_000


def test_warc_empty_and_damaged(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, archive(spark, pages, tmp_path / "e")).count() == 0
    path = archive(spark, spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), tmp_path / "d")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit("abd").cast("binary")).write.parquet(f"{path}/bad")
    import shutil

    shutil.rmtree(f"{path}/payloads")
    shutil.move(f"{path}/bad", f"{path}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archive(spark, path).collect()


# 3


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>"</script></head><body class="has-sidebar"><header><a href=/>Home</a> Site name</header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div id="cookie-notice">We use cookies to make this site better for you and everyone else.</div>
<article><h1>The &lt;title&gt;</h1><p>First  paragraph &amp; more<br>of&nbsp;it <a href=x>here</a>.</p><p>Short.<div class="ad">Buy this now, it is great and you need it more than anything else.</div>
<p><b>Unclosed bold<p>Next<!-- note --> one</p><form><label>Your name</label><input></form><section class="comments"><article><p>I like this very much, thank you for such a good text.</p></article></section></article>
<aside><p>Related things to read after this one, for you.</p></aside><footer>&copy; us</footer>"""


def test_html():
    tree = html_text.trained()
    assert html_text.main_text(PAGE, tree) == "The <title>\nFirst paragraph & more of it here.\nShort.\nUnclosed bold\nNext one"
    table = html_text.labelled()
    assert (html_text.decide(tree, table[:, :-1]) == table[:, -1]).mean() > 0.95
    long = "word " * 40
    assert html_text.main_text(f"<div>{long}</div><div><a href=x>{long}</a></div><div>{long}</div>", tree) == "\n".join([long.strip()] * 2)
    assert html_text.main_text(None, tree) == html_text.main_text("", tree) == html_text.main_text("<script>x</script>", tree) == ""


def test_html_loses_nothing_behind_missing_end_tags():
    tree = html_text.trained()
    a, b = "first words of this article " * 6, "last words of this article " * 6
    for name in ("noscript", "object", "math", "svg", "select", "iframe", "template"):
        got = html_text.main_text(f"<article><p>{a}</p><{name}><p>{b}</p></article>", tree)
        assert got == f"{a.strip()}\n{b.strip()}"
        assert html_text.main_text(f"<article><p>{a}</p><{name}>gone</{name}><p>{b}</p></article>", tree) == got
    assert html_text.main_text(f"<article><p>{a}</p><datalist id=x><option value=1>one<option>two</datalist><p>{b}</p></article>", tree) == f"{a.strip()}\n{b.strip()}"
    assert html_text.main_text(f"<article><p>{a}</p><option>one</option><p>{b}</p></article>", tree) == f"{a.strip()}\n{b.strip()}"


def test_html_marks_are_weighed():
    """Names of furniture on the article, a small marked block beside the article, links in the article, comments that are articles."""
    tree = html_text.trained()
    p = ["some words that make a paragraph of the article " * k for k in (4, 7, 3, 9)]
    body = "".join(f"<p>{x}</p>" for x in p)
    want = "\n".join(x.strip() for x in p)
    assert html_text.main_text(f'<nav><a href=x>Home</a></nav><article class="post related-post social">{body}</article><footer>us</footer>', tree) == want
    assert html_text.main_text(f'<nav><a href=x>Home</a></nav><div class="card-body">Seven words that are in a card</div><div><h1>Title of it</h1>{body}</div><footer>us</footer>', tree).endswith(want)
    links = "".join(f"<li><a href=x>Link number {k}</a></li>" for k in range(6))
    assert html_text.main_text(f"<nav><a href=x>Home</a></nav><article>{body}<ul>{links}</ul></article>", tree) == want
    said = '<article class="comment"><p>I like this a lot and say so at some length here.</p></article>' * 3
    assert html_text.main_text(f"<article>{body}</article><div>{said}</div><footer>us</footer>", tree) == want


class Reader(HTMLParser):
    """The plain reader of the given pages: blocks inside the article element."""

    INLINE = ("b", "i", "a", "em", "strong", "span", "br")

    def __init__(self):
        super().__init__()
        self.inside, self.done, self.now = 0, [], []

    def end(self):
        if text := " ".join("".join(self.now).split()):
            self.done.append(text)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside, self.now = self.inside + 1, []
        elif tag == "br":
            self.now.append(" ")
        elif tag not in self.INLINE and self.inside:
            self.end()

    def handle_endtag(self, tag):
        if tag not in self.INLINE and self.inside:
            self.end()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.now.append(data)


def test_html_against_a_plain_reader(spark):
    """Every given page as a plain reader gives it; and without class names and telling elements, by words and links alone."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_main_text(pages).collect()}
    tree = html_text.trained()
    right = n = 0
    for r in pages.collect():
        reader = Reader()
        reader.feed(r.html or "")
        assert got[r.page_id].text == "\n".join(reader.done) and got[r.page_id].n_chars == len(got[r.page_id].text)
        bare = re.sub(r"<(/?)(?:article|nav|footer)", r"<\1div", re.sub(r'\sclass="[^"]*"', "", r.html or ""))
        found = html_text.blocks(bare)
        assert all(b.place == 0 for b in found)
        keep = html_text.decide(tree, html_text.block_features(found))
        right += sum((b.text in reader.done) == bool(k) for b, k in zip(found, keep))
        n += len(found)
    assert n > 4000 and right / n > 0.95


def test_html_frame(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5, "h"), (None, None, None, 6, "t"), (2, "v", "<p>" + "long text " * 200_000, 7, "x"), (2, "v", "<p>" + "long text " * 200_000, 7, "x")], "page_id long, url string, HTML string, n_chars int, _html string")
    rows = html_text.extract_main_text(df).collect()
    assert len(rows) == 4 and all(r.n_chars == len(r.text) for r in rows) and rows[0]._html == "h"
    assert {r.page_id: r.n_chars for r in rows} == {1: len(html_text.main_text(PAGE, html_text.trained())), None: 0, 2: 1_999_999}
    assert html_text.extract_main_text(df.limit(0)).count() == 0


# 1


def tone(rng, n):
    t = np.arange(n) / chroma.RATE
    f = np.repeat(220 * 2 ** (rng.integers(0, 18, n // 700 + 1) / 12), 700)[:n]
    return (128 + 100 * np.sin(2 * np.pi * f * t) * 0.9).astype(np.uint8).tobytes()


def test_chroma(spark):
    rng = np.random.default_rng(4)
    base = tone(rng, 12_000)
    noisy = (np.frombuffer(base, np.uint8).astype(int) + rng.integers(-4, 5, len(base))).clip(0, 255).astype(np.uint8).tobytes()
    rows = [(0, base), (1, base), (2, noisy), (3, base[64 * 20 :]), (4, tone(rng, 12_000)), (5, None), (6, b""), (7, b"short"), (8, bytes(9000)), (None, base), (100, tone(rng, 9000)), (100, tone(rng, 9000))]
    df = spark.createDataFrame([(*r, "c", "q") for r in rows], "id long, pcm binary, class string, query string")
    got = {}
    for r in chroma.align(df, "id", "pcm", lambda i: i % 100 == 0).collect():
        got.setdefault(r.id, r)
    assert got[1].match == 0 and got[1].bit_error_rate == 0 and got[1].class_id == 0 and got[None].match == 0
    assert got[2].match == 0 and got[2].match_offset == 0 and got[2].bit_error_rate < 0.2
    assert got[3].match == 0 and got[3].match_offset == 20 and got[3].bit_error_rate < 0.05
    assert got[5].n_items == got[6].n_items == 0 and got[7].n_items == chroma.WIDTH and got[5].match is None and got[8].n_items > 0
    assert got[4].match is None or got[4].bit_error_rate > 0.1
    a, b = np.array([1, 2, 3], np.uint32), np.array([2, 7], np.uint32)
    assert chroma.bit_errors(a, b, 1) == (2, 1) and chroma.bit_errors(a, b, 5) == (0, 0) and chroma.bit_errors(b, a, -1) == (2, 1)
    assert chroma.align(df.limit(0), "id", "pcm", lambda i: i % 100 == 0).count() == 0


def test_chroma_short(spark):
    """Equal short recordings share a class, and a near copy of a short query is found."""
    rng = np.random.default_rng(8)
    base = tone(rng, 1200)
    near = (np.frombuffer(base, np.uint8).astype(int) + rng.integers(-2, 3, len(base))).clip(0, 255).astype(np.uint8).tobytes()
    rows = [(100, base), (1, base), (2, near), (3, b"one"), (4, b"one"), (5, b"x"), (200, b"one"), (6, None)]
    got = {r.id: r for r in chroma.align(spark.createDataFrame(rows, "id long, pcm binary"), "id", "pcm", lambda i: i % 100 == 0).collect()}
    assert got[1].class_id == got[100].class_id == 1 and got[1].match == 100 and got[2].match == 100 and got[2].bit_error_rate < 0.2
    assert got[3].class_id == got[4].class_id == got[200].class_id == 3 and got[4].match == 200 and got[6].match is None


def test_chroma_recall(spark, sf):
    """All recordings against all queries at all offsets: of the alignments over half of the shorter one with few errors, at least 9 of 10 are found."""
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120 and length(text) < 4000").collect()]
    rng = np.random.default_rng(3)
    rows += [(1000 + i, noise(rng, x, 1)[int(rng.integers(0, 200)) :]) for i, x in rows[:40]] + [(2000 + 100 * k, x) for k, (_, x) in enumerate(rows[:12])]
    prints = {i: chroma.fingerprint(x) for i, x in rows}
    clear, queries = set(), [i for i in prints if i % 100 == 0]
    for q in queries:
        for i in prints:
            if prints[i].tobytes() != prints[q].tobytes():
                rate = min((e / (32 * n) for at in range(-len(prints[i]), len(prints[q])) for n, e in [chroma.bit_errors(prints[q], prints[i], at)] if n >= max(chroma.WIDTH, min(len(prints[q]), len(prints[i])) // 2)), default=1)
                if rate <= 0.15:
                    clear.add((i, q))
    got = chroma.align(spark.createDataFrame(rows, "id long, pcm binary"), "id", "pcm", lambda i: i % 100 == 0).collect()
    of = {r.id: r.class_id for r in got}
    best = {r.id: {m.match for m in r.matches or []} for r in got}
    found = {(i, q) for i, q in clear if {of[m] for m in best[of[i]]} & {of[q]}}
    assert len(clear) >= 10 and len(found) >= 0.9 * len(clear)


def noise(rng, pcm, size):
    return (np.frombuffer(pcm, np.uint8).astype(int) + rng.integers(-size, size + 1, len(pcm))).clip(0, 255).astype(np.uint8).tobytes()


def test_box_sums():
    c = chroma.chroma(chroma.signal(tone(np.random.default_rng(1), 8000)), chroma.pitch_matrix(chroma.RATE, chroma.FRAME), chroma.FRAME, chroma.HOP)
    x = chroma.items(c)
    assert len(x) == len(c) - chroma.WIDTH + 1 and np.allclose((c**2).sum(1), 1)
    assert (x == np.concatenate([chroma.items(c[k : k + chroma.WIDTH]) for k in range(len(x))])).all()


# 6


def test_quotes_parse():
    own, quoted = quotes.parse("Hi,\n\nOn Monday Ann wrote:\n> one\n>> deep\n>> er\n> two\n>\n> three\n\nMy answer.")
    assert own == "Hi,\n\nMy answer." and quoted == [(1, "one"), (2, "deep\ner"), (1, "two"), (1, "three")]
    assert quotes.parse(None) == ("", []) and quotes.parse("a > b\n\n c") == ("a > b\n\n c", [])


def test_quotes(spark):
    rows = [
        (1, 0, "First  message here.\nSecond line."), (1, 1, "> first message HERE.\n\nReply one"), (1, 2, ">> First message here.\n> reply one\nReply two"),
        (1, 3, "> unknown text\nnothing"), (1, 4, "> Second line.\n\nLast"), (2, 0, "Reply one"), (2, 1, "> First message here.\nother conversation"),
        (2, 2, "> reply one\nyes"), (None, 0, "> Reply one\nx"), (2, None, "> Reply one"), (3, 0, None), (3, 1, ""), (1, 1, "> first message here.\nrepeated turn"),
    ]
    df = spark.createDataFrame([(*r, "user", "h") for r in rows], "conv_id long, turn long, text string, role string, hash string")
    got = {}
    for r in quotes.link_quotes(df).collect():
        got.setdefault((r.conv_id, r.turn), r)
    show = lambda *k: (got[k].n_quotes, got[k].n_linked, got[k].reply_to, got[k].thread, got[k].depth)
    assert show(1, 0) == (0, 0, None, 0, 0) and show(1, 1)[:4] == (1, 1, 0, 0) and show(1, 2) == (2, 2, 1, 0, 2)
    assert show(1, 3) == (1, 0, None, 3, 0) and show(1, 4) == (1, 1, 0, 0, 1) and got[1, 4].text == "Last"
    assert show(2, 1) == (1, 0, None, 1, 0) and show(2, 2) == (1, 1, 0, 0, 1) and show(None, 0)[1:4] == (0, None, 0)
    assert quotes.link_quotes(df).count() == len(rows) and quotes.link_quotes(df).columns[:5] == df.columns
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_long_reply_chain(spark):
    rows = [(1, 0, "text 0")] + [(1, i, f"> text {i - 1}\ntext {i}") for i in range(1, 40)]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert all(r.thread == 0 and r.depth == r.turn for r in got)


def brute_links(rows):
    """reply_to of each message by looking through all earlier ones."""
    said = {}
    for c, t, x in rows:
        said.setdefault((c, t), set()).update(quotes._own_units(quotes.parse(x)[0]))
    out = {}
    for c, t, x in rows:
        earlier = [u for (d, u) in said if d == c and u < t]
        for level, p in quotes.parse(x)[1]:
            lines = {h for y in p.split("\n") if (h := quotes._hash(y))}
            last = lambda h: max((u for u in earlier if h in said[c, u]), default=None)
            at = last(quotes._hash(p))
            if at is None:
                votes = Counter(u for h in lines if (u := last(h)) is not None)
                at = max(((n, u) for u, n in votes.items()), default=(0, None))
                at = at[1] if at[0] >= quotes.SHARE * len(lines) else None
            if at is not None:
                out.setdefault((c, t), []).append((level, at))
    return {k: (len(v), max((o for level, o in v if level == 1), default=max(o for _, o in v))) for k, v in out.items()}


def test_quotes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quotes, "RUN", 4)
    rng = np.random.default_rng(9)
    lines = [f"line number {k} of some text" for k in range(25)]
    rows = []
    for c in range(6):
        for t in range(40):
            own = "\n".join(rng.choice(lines, rng.integers(1, 4)))
            quoted = "\n".join("> " + "> " * int(rng.integers(0, 2)) + x for x in rng.choice(lines, rng.integers(1, 4)))
            rows.append((c, t, f"{quoted}\n\n{own}" if rng.random() < 0.7 else own))
    odd = "conv_id long, turn long, text string, _c int, _t int, part int, conv string, `a b` int"
    got = quotes.link_quotes(spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in rows], odd)).collect()
    want = brute_links(rows)
    assert {(r.conv_id, r.turn): (r.n_linked, r.reply_to) for r in got if r.n_linked} == want and len(want) > 80
    for c in range(6):
        order = sorted((r for r in got if r.conv_id == c), key=lambda r: r.position)
        assert [r.position for r in order] == list(range(40)) and [(r.thread, r.turn) for r in order] == sorted((r.thread, r.turn) for r in order)
        up = {r.turn: r.reply_to for r in order}
        for r in order:
            t, steps = r.turn, 0
            while up[t] is not None:
                t, steps = up[t], steps + 1
            assert (r.thread, r.depth) == (t, steps)


def test_quotes_false_friends(spark):
    """One common line doesn't link a passage, and a repeat of an old turn isn't taken for the turn quoted."""
    rows = [(1, 0, "Thanks"), (1, 1, "Hello there"), (1, 2, "> Completely different text nobody said.\n> And more of it.\n> Thanks\nyes"), (1, 3, "Hello there"), (1, 4, "> Hello there\nhi")]
    got = {r.turn: r for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert got[2].n_quotes == 1 and got[2].n_linked == 0 and got[2].reply_to is None and got[4].reply_to == 3


def test_quoting_replies(spark, sf):
    """Every reply made by the rule is linked with the turn it answers, and its own text comes back."""
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    said = {(r.conv_id, r.turn): r.text for r in table.collect()}
    got = quotes.link_quotes(quotes.quoting_replies(table)).collect()
    assert len(got) == len(said) and sum(r.n_quotes > 0 for r in got) > len(said) / 3
    for r in got:
        up = r.turn - (2 if r.turn % 3 == 0 else 1)
        assert r.text.strip("\n") == said[r.conv_id, r.turn].strip("\n")
        if (r.conv_id, up) in said:
            assert r.n_linked == r.n_quotes > 0 and (r.reply_to == up or said[r.conv_id, r.reply_to] == said[r.conv_id, up])
    assert quotes.quoting_replies(table.limit(0)).count() == 0
