"""Hierarchical multi-length packing of token sequences.

Context sizes form tiers (2048, 1024, 512, 256).  A document longer than the
largest window gives whole windows first; what remains is routed to the
smallest tier that holds it.  Tiers are packed from the largest down: an item
opens a window of its tier, and the rest of that window is filled from shorter
tiers, best fit first, then with the front of a longer item cut to size.  What
can't fill a window of a smaller tier is bundled into the largest windows.  So
every sequence is as long as its tier, a power of two, but for the last one of a
group, which alone is padded.  Step groups hold sequences of one length and an
equal number of tokens, over all packs.

Documents are dealt to groups of about GROUP by a hash of a row number, which is
fixed by a written table before the deal; a group holds at most GROUP tails of
less than one window, whatever the texts' lengths, sources or copies.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .arrow_text import trimmed
from .bpe import PATTERN, ByteBPE, byte_alphabet, vocabulary
from .store import stage

TIERS = (2048, 1024, 512, 256)
GROUP = 2000  # documents packed together: at most 2000 tails of 2047 ids, 16 MB
MIN_CUT = 16
STEP_TOKENS = 16 * 2048
END_ID = 1
RUN = 10_000  # packs whose sequences are added up together


class RankEncoder:
    """The ids of :class:`ByteBPE`, by a library that takes merge ranks; needs a vocabulary whose ids are in merge order."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
        in_order = [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])]
        if in_order != sorted(set(in_order)):
            raise ValueError("ids aren't in merge order")
        ranks = {bytes(alphabet[c] for c in s): i for s, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.codec = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        return self.codec.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(data: bytes):
    try:
        return RankEncoder(data)
    except ValueError:
        return ByteBPE(data)


class _Shelf:
    """Items by length; the longest one up to a length, or the shortest above it, in a few machine operations."""

    def __init__(self):
        self.items, self.mask = defaultdict(list), 0

    def put(self, length: int, item: tuple) -> None:
        self.items[length].append(item)
        self.mask |= 1 << length

    def take(self, length: int) -> tuple:
        item = self.items[length].pop()
        if not self.items[length]:
            self.mask &= ~(1 << length)
        return item

    def fitting(self, most: int) -> int:
        return (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1

    def above(self, least: int) -> int:
        rest = self.mask >> least
        return least + (rest & -rest).bit_length() - 1 if rest else -1


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) that hold every token of items of up to one largest window each."""
    top, shelf = tiers[0], _Shelf()
    for k, n in enumerate(lengths):
        if n:
            shelf.put(n, (k, 0))
    done, loose = [], []
    for depth, tier in enumerate(tiers):
        shorter = tiers[depth + 1] if depth + 1 < len(tiers) else 0
        while (n := shelf.fitting(tier)) > shorter:
            k, at = shelf.take(n)
            window, room = [(k, at, n)], tier - n
            while room:
                if (m := shelf.fitting(room)) > 0:
                    k, at = shelf.take(m)
                elif room >= MIN_CUT and (long := shelf.above(room + MIN_CUT)) > 0:
                    m = room
                    k, at = shelf.take(long)
                    shelf.put(long - room, (k, at + room))
                else:
                    break
                window.append((k, at, m))
                room -= m
            (loose if room else done).append(window)
    window, room = [], top
    for piece in sorted((p for w in loose for p in w), key=lambda p: -p[2]):
        k, at, n = piece
        while n:
            m = min(n, room)
            window.append((k, at, m))
            at, n, room = at + m, n - m, room - m
            if not room:
                done.append(window)
                window, room = [], top
    return [*done, window] if window else done


#: step_group holds the sequence's place among those of its window in the pack, until packs are put in order
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("window", pa.int64()), ("step_group", pa.int64())])
PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, window long, step_group long"


def _pack_group(key: tuple, table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["row"])
    group, top = key[0].as_py(), TIERS[0]
    sequences = [[(k, top * j, top, crc)] for k, r in enumerate(rows) for j, crc in enumerate(r["whole"])]
    tails = [len(r["tail"]) // 4 for r in rows]
    for window in pack(tails):
        sequences.append([(k, top * len(rows[k]["whole"]) + at, n, zlib.crc32(memoryview(rows[k]["tail"])[4 * at : 4 * (at + n)])) for k, at, n in window])
    out = {n: [] for n in PIECES.names}
    filled: dict[int, int] = defaultdict(int)
    for s, window in enumerate(sequences):
        total = sum(p[2] for p in window)
        padded = total if total & (total - 1) == 0 else top
        place, offset = filled[padded], 0
        filled[padded] += 1
        for k, start, n, crc in window:
            for name, value in zip(PIECES.names, (rows[k]["doc_id"], start, n, crc, top * len(rows[k]["whole"]) + tails[k], (group << 32) + s, offset, total, padded, place)):
                out[name].append(value)
            offset += n
    return pa.Table.from_pydict(out, schema=PIECES)


def pack_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row per piece of a document in a packed sequence.

    A document is its ids and END_ID; doc_tokens counts both.  ``start`` counts the
    document's ids before the piece, ``offset`` the sequence's.  ``ids_crc32`` is of
    the piece's ids as little-endian unsigned 32-bit integers.  ``window`` is the
    sequence's padded length: sequence_tokens if that is a power of two, else 2048.
    ``step_group`` names groups of sequences of one window with STEP_TOKENS tokens
    each, over the whole table; only the last group of a window may have fewer.

    A null text counts as empty and gives one piece, END_ID.  Null ids and
    repeated rows are documents of their own.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    shared, top = vocabulary(docs.sparkSession, vocab_path), TIERS[0]

    @trimmed
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(shared.value)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                whole, tail = [], []
                for text in part.column(1).to_pylist():
                    x = memoryview(code.encode(text or "") + end)
                    n = len(x) // (4 * top)
                    whole.append([zlib.crc32(x[4 * top * j : 4 * top * (j + 1)]) for j in range(n)])
                    tail.append(bytes(x[4 * top * n :]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole, pa.list_(pa.int64())), pa.array(tail, pa.binary())], ["doc_id", "whole", "tail"])

    coded = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(ids, "doc_id long, whole array<long>, tail binary")
    held = stage(coded.withColumn("row", F.monotonically_increasing_id()), "tails")
    groups = max(1, -(-held.count() // group))
    packed = stage(held.withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("pack").applyInArrow(_pack_group, PIECES_SQL), "pieces")
    # where the sequences of a pack begin among all of their window: a row for each pack and window, added up in two levels
    size = packed.groupBy(F.shiftright("sequence_id", 32).alias("pack"), F.col("window").alias("w")).agg((F.max("step_group") + 1).alias("n"))
    size = size.withColumn("run", F.floor(F.col("pack") / RUN))
    before = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = size.groupBy("w", "run").agg(F.sum("n").alias("n")).select("w", "run", before("w", "run").alias("above"))
    begin = size.select("w", "run", "pack", before("w", "run", "pack").alias("within")).join(run, ["w", "run"]).select("w", "pack", (F.col("above") + F.col("within")).alias("begin"))
    at = packed.join(begin, (F.shiftright("sequence_id", 32) == F.col("pack")) & (F.col("window") == F.col("w")))
    step = F.floor((F.col("begin") + F.col("step_group")) * F.col("window") / STEP_TOKENS)
    return at.select(*[(F.col("window") * F.lit(1 << 44) + step).cast("long").alias(c) if c == "step_group" else F.col(c) for c in packed.columns])
