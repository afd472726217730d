"""Quality rules: base counts of a text and language-specific perplexity bands.

The language model is one of code points (gram_model.py), which grows with the
corpus.  Its entries are broadcast in shards of SHARD_ENTRIES, documents pass
through each, and each adds its share to the log probability of a text.  The sums
are staged, a row for each distinct text; bands and documents take them from there.

Perplexity is per word that has a letter or digit.  Its logarithm is held against
a band of its language: BAND times the width of the shortest interval that holds
half of the distinct texts that pass the base rules, below and above that interval.
Junk in up to half of the distinct texts, and copies of a text in any number,
don't move the interval into the junk.  Junk that puts signs between or into words,
gibberish and words in a wrong order cost more per word than prose, and text of
few, frequent words costs less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .arrow_text import Texts, chunks, trimmed
from .gram_model import CHUNK, Shard, arrays, entries
from .store import discard, named, stage, unused
from .text_stats import text_stats

BAND = 3.0
LEAST_SPREAD = 0.01  # of the interval's lower end: its width counts as at least this
SHARD_ENTRIES = 3 << 20  # of 24 bytes
BROADCAST_TEXTS = 1_000_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = [*BASE, "base_failed", "log_perplexity"]
_NEEDED = frozenset(["n_symbols"])


def _keys(texts: Texts, langs: list[str]) -> pa.Array:
    return pa.array([xxh3_128_digest(x.encode() + b"\0" + texts.data[a:b].tobytes()) for x, a, b in zip(langs, texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())], pa.binary())


def _parts(pairs: DataFrame, shared, base: bool) -> DataFrame:
    """Rows (key, part, lang, failed, per) of (lang, text): what a shard adds to a text's log probability, and, if ``base`` asks for it, its language, whether it fails the base rules and the words that its perplexity is divided by."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(shared.value)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for texts in chunks(batch.column(1), CHUNK):
                here = langs[texts.first : texts.first + len(texts)]
                last = [pa.nulls(len(texts), x) for x in (pa.string(), pa.bool_(), pa.int64())]
                if base:
                    stats = text_stats(texts, _NEEDED)
                    last = [pa.array(here, pa.string()), pa.array(_failed(stats)), pa.array(stats["n_lexical"], pa.int64())]
                yield pa.RecordBatch.from_arrays([_keys(texts, here), pa.array(shard.log_probabilities(texts, here)), *last], ["key", "part", "lang", "failed", "per"])

    return pairs.mapInArrow(run, "key binary, part double, lang string, failed boolean, per long")


def _failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def _based(docs: DataFrame, where_lang: int, where_text: int, names: list[str], schema: str, key: str) -> DataFrame:
    """``docs`` with the base counts and the text's key."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = [x or "" for x in batch.column(where_lang).cast(pa.string()).to_pylist()]
            for texts in chunks(batch.column(where_text), CHUNK):
                part = batch.slice(texts.first, len(texts))
                stats = text_stats(texts, _NEEDED)
                last = [*(pa.array(stats[x], pa.int64()) for x in BASE), pa.array(_failed(stats)), _keys(texts, langs[texts.first : texts.first + len(texts)])]
                yield pa.RecordBatch.from_arrays([*part.columns, *last], [*names, *BASE, "base_failed", key])

    return docs.mapInArrow(run, schema + f"`{key}` binary")


def _measured(spark: SparkSession, docs: DataFrame, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with STATS, and a staged row (key, lang, failed, x) for each distinct text of a language: x is its log perplexity."""
    docs = docs.drop(*STATS)
    lang_col, text_col = named(docs, lang_col), named(docs, text_col)
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(""))
    pairs = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    listed = entries(pairs)
    model, n, buckets = arrays(listed)
    discard(listed)
    shards = max(1, -(-n // SHARD_ENTRIES))
    step = -(-buckets // shards)
    parts = None
    for k in range(0, buckets, step):
        rows = model.where(F.col("bucket").between(k, k + step - 1)).collect()
        shared = spark.sparkContext.broadcast([(r.bucket, *(bytes(r[c]) for c in ("keys", "ta", "tb", "wa", "wb"))) for r in rows])
        here = _parts(pairs, shared, k == 0).withColumn("shard", F.lit(k))
        parts = here if parts is None else parts.union(here)
    # equal texts have equal parts: one of each shard counts
    facts = ("lang", "failed", "per")
    sums = parts.groupBy("key", "shard").agg(F.max("part").alias("part"), *[F.max(c).alias(c) for c in facts])
    sums = sums.groupBy("key").agg(F.sum("part").alias("total"), *[F.max(c).alias(c) for c in facts])
    texts = stage(sums.select("key", "lang", "failed", F.when(F.col("per") > 0, -F.col("total") / F.col("per")).alias("x")), "perplexities")

    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    names = docs.columns
    where_lang, where_text = (names.index(c) for c in (lang_col, text_col))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema) + "".join(f"{x} long, " for x in BASE) + "base_failed boolean, "
    key = unused([*names, *STATS], "_key")
    found = texts.select(F.col("key").alias(key), F.col("x").alias("log_perplexity"))
    found = F.broadcast(found) if texts.count() <= BROADCAST_TEXTS else found
    return _based(docs, where_lang, where_text, names, schema, key).join(found, key, "left").drop(key), texts


def score(spark: SparkSession, docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``docs`` with STATS.

    Null texts count as empty and have no perplexity, as texts without a letter or
    digit; a null language is one of its own; equal texts have equal figures.
    """
    return _measured(spark, docs, lang_col, text_col)[0]


def bands(texts: DataFrame) -> DataFrame:
    """Rows (lang, lower, upper) of rows (lang, failed, x): the bounds of each language, from its distinct texts that pass the base rules; a language without any has no row."""
    q = texts.where("not failed and x is not null").groupBy("lang")
    q = q.agg(F.percentile_approx("x", [k / 100 for k in range(101)], 10000).alias("q"))
    half = F.expr("array_min(transform(sequence(0, 50), k -> struct(q[k + 50] - q[k] AS width, q[k] AS low, q[k + 50] AS high)))")
    q = q.select("lang", half.alias("h"))
    fence = BAND * F.greatest(F.col("h.width"), LEAST_SPREAD * F.abs("h.low"))
    return q.select("lang", (F.col("h.low") - fence).alias("lower"), (F.col("h.high") + fence).alias("upper"))


def quality_rules(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``docs`` with STATS, lower, upper and kept.

    base_failed: fewer than 50 words, or more than half the words in 3-word
    windows that recur in the text.  kept: the base rules pass and log_perplexity
    is within its language's band, bounds included.

    Words are runs outside ASCII white space.  A null text counts as empty: no
    words, base_failed, log_perplexity null.  A null language is a language of its
    own.  Very long texts are scored whole.  Equal texts have equal figures, and
    repeated rows stay.  Columns of ``docs`` with the new names are replaced,
    others stay, whatever their names.  An empty table gives an empty result.
    """
    docs = docs.drop("lower", "upper", "kept")
    scored, texts = _measured(docs.sparkSession, docs, lang_col, text_col)
    band = stage(bands(texts), "perplexity-bands")
    key = unused(scored.columns, "_lang")
    band_small = band.count() <= 100_000
    band = band.withColumnRenamed("lang", key)
    joined = scored.join(F.broadcast(band) if band_small else band, F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")) == F.col(key), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return joined.drop(key).withColumn("kept", ~F.col("base_failed") & inside)
