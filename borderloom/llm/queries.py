"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_digests
from .chroma import align
from .gam import quality_scores
from .html_text import extract_main_text
from .lines import drop_frequent_lines
from .ngram_join import ngram_jaccard_join
from .packing import pack_documents
from .quality_rules import BASE, quality_rules
from .quotes import link_quotes, quoting_replies
from .store import shared_dir, small_batches
from .warc import parse_records, read_archive, write_archive


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table has audio: the bytes of a text are read as 8-bit PCM."""
    return align(_table(spark, sf_dir, "documents"), "doc_id", "text", lambda i: i % 100 == 0).withColumnRenamed("id", "doc_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(_table(spark, sf_dir, "pages"), path)
    return parse_records(read_archive(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(_table(spark, sf_dir, "documents"), vocabulary_path())


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's turns hold no quotations: they are made by a rule (see quoting_replies)."""
    linked = link_quotes(quoting_replies(_table(spark, sf_dir, "conversations")))
    return linked.select("conv_id", "position", "turn", "role", "text", "n_quotes", "n_linked", "reply_to", "thread", "depth")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules(docs).select("doc_id", *BASE, "base_failed", "kept", "log_perplexity", "lower", "upper")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_frequent_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary_path())


_QUERIES = [op1_chroma, op2_warc, op3_html_text, op4_ngram_jaccard_join, op5_quality_gam, op6_quotes, op7_quality_rules, op8_line_dedup, op9_packing, op10_bpe]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


_OP2_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
g AS (SELECT *, list_transform(range(8), lambda k: CAST('0x' || substr(x, CAST(5 * k + 1 AS BIGINT), 5) AS BIGINT)) AS v FROM d)
SELECT page_id, strlen(h) AS payload_bytes, list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31), 1)), 'string_agg', '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM g"""

_OP8_SQL = """WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, TRUE AS gone FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10), m AS (SELECT k.*, coalesce(gone, FALSE) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY rid, doc_id"""


def oracle_sql() -> dict[str, str]:
    """The others are beyond SQL, or too slow in it over whole tables; tests hold them against brute force."""
    return {"op2_warc": _OP2_SQL, "op8_line_dedup": _OP8_SQL}
