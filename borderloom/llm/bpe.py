"""Byte-level BPE encoding and decoding.

Encoding splits a text at special tokens, then into pieces by the GPT-2 pattern.
A piece's symbols form a doubly linked list; a priority queue holds adjacent
pairs by (merge rank, position).  The best pair is merged and its new neighbours
are queued; entries whose symbols have changed meanwhile are stale and skipped.
Pieces repeat, so a worker keeps the ids of pieces it has met; the table is
emptied when it is full, which bounds memory and changes no result.

Decoding concatenates the vocabulary strings of the ids and reads the bytes as
UTF-8.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import trimmed

# fixed values: the pattern that splits text before the merges, and its white space
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
MAX_FILE = 64 << 20
CACHE = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file, read once by the driver and checked to be of bounded size before it is broadcast."""
    data = Path(path).read_bytes()
    if len(data) > MAX_FILE:
        raise ValueError(f"{path} has {len(data)} bytes; at most {MAX_FILE} are broadcast")
    return data


class ByteBPE:
    def __init__(self, data: bytes):
        spec = json.loads(data)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for s, i in vocab.items():
            self.strings[i] = raw(s)
        for s, i in self.special.items():
            self.strings[i] = s.encode()
        self.of_byte = [0] * 256
        for c, b in alphabet.items():
            if c in vocab:
                self.of_byte[b] = vocab[c]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.pieces = regex.compile(PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.loose = regex.compile(rf"[{_WS}] | [{_WS}]|^ | $").search
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        n = len(data)
        symbol = [self.of_byte[b] for b in data]
        if n < 2:
            return symbol
        merges = self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            if m := merges.get((symbol[i], symbol[i + 1])):
                queue.append((m[0], i, symbol[i], symbol[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if symbol[i] != a or j < 0 or symbol[j] != b:
                continue  # stale: one of the two has been merged since
            symbol[i], symbol[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((new, symbol[k])):
                    heapq.heappush(queue, (m[0], i, new, symbol[k], m[1]))
            h = before[i]
            if h >= 0 and (m := merges.get((symbol[h], new))):
                heapq.heappush(queue, (m[0], h, symbol[h], new, m[1]))
        out, i = [], 0
        while i >= 0:
            out.append(symbol[i])
            i = after[i]
        return out

    def _piece(self, piece: str) -> bytes:
        out = self.known_pieces.get(piece)
        if out is None:
            out = b"".join(map(self.packed.__getitem__, self.merge(piece.encode())))
            if len(self.known_pieces) >= CACHE:
                self.known_pieces.clear()
            if len(piece) <= 64:
                self.known_pieces[piece] = out
        return out

    def _learn(self, word: str) -> bytes:
        """Ids of a space and the word after it."""
        if len(self.known) >= CACHE:
            self.known.clear()
        out = b"".join(map(self._piece, self.pieces(" " + word)))
        if len(word) <= 64:
            self.known[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A single space between two other characters always begins a piece, so a
        text cut there has the same pieces; texts with other white space beside a
        space are cut by the pattern only.
        """
        known, learn = self.known.get, self._learn
        out = []
        for k, part in enumerate(self.split(text) if self.split else [text]):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            elif self.loose(part):
                out += map(self._piece, self.pieces(part))
            else:
                first, *rest = part.split(" ")
                out += map(self._piece, self.pieces(first))
                out += [known(w) or learn(w) for w in rest]
        return b"".join(out)

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def vocabulary(spark, path: str):
    """Broadcast of the vocabulary file."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


@lru_cache(maxsize=1)
def codec(data: bytes) -> ByteBPE:
    """A worker's codec, made once from the broadcast file."""
    return ByteBPE(data)


def bpe_encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids binary, decoded string): the ids of each whole text and what they decode to.

    A null text counts as empty: no ids, decoded to ''.  Ids are little-endian
    unsigned 32-bit integers.  Null ids and repeated rows stay; other columns are
    ignored; an empty table gives an empty result.
    """
    shared = vocabulary(docs.sparkSession, vocab_path)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary, decoded string")


def encode_digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of :func:`bpe_encode`."""
    return bpe_encode(docs, vocab_path).select(
        "doc_id",
        F.expr("cast(length(ids) / 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
