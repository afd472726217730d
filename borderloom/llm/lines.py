"""Removal of lines that many documents share.

Lines are hashed (128 bits of the normalised line) and a map task adds up in how
many of its documents each hash stands, so a line that every document has costs
one row a task; the sums are then added by key.  Hashes at the threshold and
above are the frequent lines.  While there are few of them (FREQUENT at most, a
checked count) every executor gets them and texts are filtered where they lie;
beyond that, lines are joined with them, and the positions to drop are joined
back to the texts, by content, so that equal texts are handled once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .arrow_text import trimmed
from .store import named, stage, unused

FREQUENT = 500_000  # 16-byte hashes, 8 MB
FLUSH = 200_000


def line_key(line: bytes) -> bytes:
    """ASCII white space off both ends, A-Z to a-z."""
    return line.strip().lower()


def _digest(key: bytes, min_chars: int) -> bytes | None:
    if len(key) < 4 * min_chars and sum(b & 0xC0 != 0x80 for b in key) < min_chars:
        return None
    return xxh3_128_digest(key)


def _hashes(text: str | None, min_chars: int) -> list[bytes | None]:
    return [_digest(line_key(x), min_chars) for x in (text or "").encode().split(b"\n")]


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text") -> DataFrame:
    """Rows (line binary, docs long): hashes of normalised lines that at least ``min_docs`` documents have.

    A null text is one empty line; keys of fewer than ``min_chars`` code points don't
    count; a document counts once for a line, and repeated rows are documents of their
    own.  Other columns are ignored; an empty table gives an empty result.
    """

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.binary()), pa.array(count.values(), pa.int64())], ["line", "docs"])
            count.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                count.update({h for h in _hashes(text, min_chars) if h})
                if len(count) >= FLUSH:
                    yield flush()
        if count:
            yield flush()

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "line binary, docs long")
    return rows.groupBy("line").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", broadcast_at_most: int = FREQUENT) -> DataFrame:
    """``docs`` with its text less the frequent lines, and n_lines, n_dropped (before any column of these names).

    Texts are split at \\n; a null text is one empty line and comes back as ''.
    A line's key is the line stripped of ASCII white space, A-Z folded; keys of
    fewer than ``min_chars`` code points never go.  A document counts once for a
    key; repeated rows are documents of their own.  Other columns are kept, but
    columns named n_lines or n_dropped are replaced.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    text_col = named(docs, text_col)
    frequent = stage(frequent_lines(docs, min_docs, min_chars, text_col).select("line"), "frequent-lines")
    n = frequent.count()
    names = docs.columns
    where = names.index(text_col)
    content, drop_col = (unused(docs.columns, x) for x in ("_content", "_drop"))
    schema = f"{', '.join(f'`{f.name}` {'string' if f.name == text_col else f.dataType.simpleString()}' for f in docs.schema)}, n_lines long, n_dropped long"

    def rebuilt(part: pa.RecordBatch, texts: list, drops: list) -> pa.RecordBatch:
        kept, lines, dropped = [], [], []
        for text, drop in zip(texts, drops):
            all_lines = (text or "").split("\n")
            left = [x for x, gone in zip(all_lines, drop) if not gone] if drop is not None else all_lines
            kept.append("\n".join(left))
            lines.append(len(all_lines))
            dropped.append(len(all_lines) - len(left))
        columns = [*part.columns[: len(names)]]
        columns[where] = pa.array(kept, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    if n <= broadcast_at_most:
        shared = spark.sparkContext.broadcast(frozenset(frequent.toArrow().column(0).to_pylist()))

        @trimmed
        def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gone = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    texts = part.column(where).to_pylist()
                    yield rebuilt(part, texts, [[h in gone for h in _hashes(t, min_chars)] for t in texts])

        return docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string")).mapInArrow(here, schema)

    @trimmed
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = [(p, h) for p, h in enumerate(_hashes(text, min_chars)) if h]
                yield pa.RecordBatch.from_arrays([pa.array([xxh3_128_digest((text or "").encode())] * len(found), pa.binary()), pa.array([p for p, _ in found], pa.int32()), pa.array([h for _, h in found], pa.binary())], ["content", "pos", "line"])

    @trimmed
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([xxh3_128_digest((t or "").encode()) for t in texts], pa.binary())], [*batch.schema.names, content])

    @trimmed
    def there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            drops = []
            for t, pos in zip(texts, batch.column(batch.num_columns - 1).to_pylist()):
                at = set(pos or [])
                drops.append([p in at for p in range((t or "").count("\n") + 1)])
            yield rebuilt(batch, texts, drops)

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    hits = texts.mapInArrow(lines, "content binary, pos int, line binary").join(frequent, "line", "left_semi")
    marked = hits.groupBy(F.col("content").alias(content)).agg(F.collect_set("pos").alias(drop_col))
    typed = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    with_content = typed.mapInArrow(digests, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in typed.schema)}, {content} binary")
    return with_content.join(marked, content, "left").select(*[f"`{c}`" for c in docs.columns], drop_col).mapInArrow(there, schema)
