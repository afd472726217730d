"""Chroma audio fingerprints and their alignment.

A recording is cut into overlapping windowed frames; each frame's spectrum is
folded onto the 12 pitch classes, smoothed in time and normalised.  Sixteen
box filters over an integral image of time and pitch class are quantised to two
bits each and packed, so every position of the filter window gives one unsigned
32-bit integer.

Recordings with equal fingerprints are one class.  Two classes are candidates
when they share a landmark, a byte of four consecutive integers; shared
landmarks vote for the offset between their positions, and at the offsets with
most votes the bit errors of the overlap are counted.  A stationary sound
repeats one integer, has no landmark and is found through its class only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .arrow_text import trimmed
from .store import stage

RATE, FRAME, HOP = 1378, 512, 64  # an eighth of 11025 Hz; 0.37 s frames
LOW, HIGH = 28.0, 3520.0
WIDTH = 16  # frames a filter may span
FRAMES_AT_ONCE = 2048
ROWS_AT_ONCE = 1 << 14  # chroma rows that are filtered in one pass
#: kind, first pitch class, classes, frames of each filter, by a rule: all kinds at several heights and widths
FILTERS = [(k % 6, (5 * k) % 8, 2 + k % 4 if k % 6 else 1 + k % 3, (4, 8, 12, 16)[k % 4]) for k in range(16)]
CUTS = (-0.12, 0.0, 0.12)
GRAY = np.array([0, 1, 3, 2], np.uint32)
MOST_ERRORS = 0.35
BLOCK_BYTES = 4 << 20
OFFSETS = 8  # of most votes, whose bit errors are counted
MOST_HITS = 2_000_000  # landmark hits that are counted at once
STEP = 16  # integers that are compared as one value: eight of 64 bits
STEPS_AT_ONCE = 1 << 14  # in one pass
HEADS = np.where(np.arange(STEP) < np.arange(STEP + 1)[:, None], 0xFFFFFFFF, 0).astype("<u4").view(f"V{4 * STEP}").ravel()  # by r: the first r of them
PAIRS, ONES = np.uint64(0x00FF00FF00FF00FF), np.uint64(0x0001000100010001)
MIDDLE = 1 << 31
MOST_LINKS = 500_000  # pairs of recordings and queries that a worker hands out at once (32 bytes a link)
KEPT_BLOCKS = 4  # whose landmarks a worker keeps; those of others are sorted anew for each step
MATCHES = "array<struct<match: bigint, match_offset: bigint, overlap: bigint, bit_error_rate: double>>"
ALIGNED = f"id long, n_items long, class_id long, match long, match_offset long, overlap long, bit_error_rate double, matches {MATCHES}"


def pitch_matrix(rate: int, frame: int) -> np.ndarray:
    """Spectrum bins by pitch classes."""
    f = np.fft.rfftfreq(frame, 1 / rate)
    out = np.zeros((len(f), 12))
    inside = np.flatnonzero((f >= LOW) & (f <= min(HIGH, rate / 2)))
    out[inside, np.floor(12 * np.log2(f[inside] / 440.0)).astype(int) % 12] = 1
    return out


def signal(data: bytes, kind: str = "u8") -> np.ndarray:
    if kind == "u8":
        return (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128
    return np.frombuffer(data[: len(data) // 2 * 2], "<i2").astype(np.float32) / 32768


def chroma(x: np.ndarray, matrix: np.ndarray, frame: int, hop: int) -> np.ndarray:
    """A normalised row of 12 for each frame."""
    if len(x) < frame:
        return np.zeros((0, 12))
    views = np.lib.stride_tricks.sliding_window_view(x, frame)[::hop]
    window = np.hanning(frame).astype(np.float32)
    parts = []
    for at in range(0, len(views), FRAMES_AT_ONCE):
        spectrum = np.fft.rfft(views[at : at + FRAMES_AT_ONCE] * window, axis=1)
        parts.append((spectrum.real**2 + spectrum.imag**2) @ matrix)
    c = np.concatenate(parts)
    padded = np.pad(c, ((2, 2), (0, 0)), "edge")
    smooth = sum(w * padded[k : k + len(c)] for k, w in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    norm = np.sqrt((smooth**2).sum(1, keepdims=True))
    return np.where(norm > 1e-9, smooth / np.maximum(norm, 1e-9), 0)


def box_totals(c: np.ndarray) -> np.ndarray:
    """Sums of chroma rows over time and pitch class from the first row on: 13 rows, a column more than there are frames."""
    total = np.zeros((13, len(c) + 1))
    total[1:, 1:] = c.cumsum(0).cumsum(1).T
    return total


def packed(total: np.ndarray) -> np.ndarray:
    """An integer for each column of box totals that WIDTH others follow."""
    n = total.shape[1] - WIDTH
    area = lambda a, b, y0, y1: total[y1, b : b + n] - total[y1, a : a + n] - total[y0, b : b + n] + total[y0, a : a + n]  # noqa: E731  frames a to b, classes y0 to y1
    out = np.zeros(n, np.uint32)
    for kind, y, h, w in FILTERS:
        y1, hh, hw, third = y + h, y + max(1, h // 2), w // 2, w // 3
        whole = area(0, w, y, y1)
        if kind == 0:
            a, b = whole, area(0, w, (y + 6) % 12 - max(0, (y + 6) % 12 + h - 12), (y + 6) % 12 - max(0, (y + 6) % 12 + h - 12) + h)
        elif kind == 1:
            a = area(0, w, y, hh)
            b = whole - a
        elif kind == 2:
            a = area(0, hw, y, y1)
            b = whole - a
        elif kind == 3:
            a = area(0, hw, y, hh) + area(hw, w, hh, y1)
            b = whole - a
        elif kind == 4:
            a = area(third, 2 * third, y, y1)
            b = (whole - a) / 2
        else:
            mid = y + max(1, h // 3)
            a = area(0, w, mid, min(y1, mid + max(1, h // 3)))
            b = (whole - a) / 2
        level = np.searchsorted(CUTS, np.log1p(np.maximum(a, 0)) - np.log1p(np.maximum(b, 0)))
        out = (out << np.uint32(2)) | GRAY[level]
    return out


def items(c: np.ndarray) -> np.ndarray:
    """Packed integers of chroma rows, one for each position of a window of WIDTH frames."""
    return packed(box_totals(c)) if len(c) >= WIDTH else np.zeros(0, np.uint32)


def items_of(chromas: list[np.ndarray]) -> list[np.ndarray]:
    """:func:`items` of each, in one pass: their totals stand one after another, and windows over two of them are left out."""
    width = np.array([len(c) + 1 for c in chromas])
    if not len(width) or width.sum() <= WIDTH:
        return [items(c) for c in chromas]
    every = packed(np.concatenate([box_totals(c) for c in chromas], axis=1))
    start = np.cumsum(width) - width
    return [every[a : a + max(0, n - WIDTH)] for a, n in zip(start.tolist(), width.tolist())]


def filled(x: np.ndarray, frame: int, hop: int) -> np.ndarray:
    """A signal, played again and again until it gives WIDTH integers if it is too short for that; nothing stays nothing."""
    least = frame + (2 * WIDTH - 2) * hop
    return np.resize(x, least) if 0 < len(x) < least else x


def fingerprint(data: bytes, kind: str = "u8", rate: int = RATE, frame: int = FRAME, hop: int = HOP, matrix: np.ndarray | None = None) -> np.ndarray:
    """Packed integers of PCM bytes; a short recording is played again until it has WIDTH of them, and only one without a sample has none."""
    return items(chroma(filled(signal(data, kind), frame, hop), pitch_matrix(rate, frame) if matrix is None else matrix, frame, hop))


def bit_errors(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, int]:
    """Overlap of a and b, moved by ``offset``, in integers, and the bits that differ in it."""
    i, j = max(0, offset), max(0, -offset)
    n = min(len(a) - i, len(b) - j)
    if n <= 0:
        return 0, 0
    return n, int(np.bitwise_count(a[i : i + n] ^ b[j : j + n]).sum())


def fingerprints(recordings: DataFrame, id_col: str, data_col: str, kind: str = "u8", rate: int = RATE, frame: int = FRAME, hop: int = HOP) -> DataFrame:
    """Rows (id, n_items, items binary, class binary) of a column of PCM bytes; null bytes are silence of no length."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = pitch_matrix(rate, frame)

        def rows(part: pa.RecordBatch) -> pa.RecordBatch:
            found, held, n = [], [], 0
            for x in part.column(1):
                held.append(chroma(filled(signal(x.as_py() or b"", kind), frame, hop), matrix, frame, hop))
                n += len(held[-1])
                if n >= ROWS_AT_ONCE:
                    found += [y.astype("<u4").tobytes() for y in items_of(held)]
                    held, n = [], 0
            found += [y.astype("<u4").tobytes() for y in items_of(held)]
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(found, pa.binary()), pa.array([xxh3_128_digest(x) if x else None for x in found], pa.binary())],
                ["id", "n_items", "items", "class"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield rows(batch.slice(at, 512))

    return recordings.select(F.col(id_col).cast("long").alias("id"), F.col(data_col).cast("binary").alias("data")).mapInArrow(run, "id long, n_items long, items binary, class binary")


class Links(NamedTuple):
    """Aligned queries of a recording, best first."""

    rate: np.ndarray
    overlap: np.ndarray
    query: np.ndarray
    offset: np.ndarray


def in_order(parts: list[Links]) -> Links:
    """Links of several blocks as one, by bit error rate, then longer overlaps, then smaller ids."""
    x = parts[0] if len(parts) == 1 else Links(*map(np.concatenate, zip(*parts)))
    order = np.lexsort((x.query, -x.overlap, x.rate))
    return Links(*(y[order] for y in x))


def runs_of(n: np.ndarray, most: int) -> list[slice]:
    """Slices of consecutive counts of about ``most`` together."""
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(n) // most)) + 1).tolist(), len(n)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def firsts(x: np.ndarray) -> np.ndarray:
    """Places in sorted ``x`` where another value begins."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])


def windows(x: np.ndarray) -> np.ndarray:
    """STEP integers from each place of ``x`` on as one value, zeros behind its end; a view of one padded copy."""
    padded = np.concatenate([x, np.zeros(STEP, np.uint32)])
    return np.ndarray(len(x), f"V{4 * STEP}", padded, strides=(4,))


class QueryBlock:
    """Some query classes, with their landmarks by key (8 bytes each and 16 a different key, up to four an integer: at most 24 times the fingerprints)."""

    def __init__(self, names: list[int], prints: list[bytes]):
        self.names = np.array(names, np.int64)
        found = [np.frombuffer(x, "<u4") for x in prints]
        self.size = np.array([len(x) for x in found], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.windows = windows(np.concatenate([*found, np.zeros(0, np.uint32)]))
        marks = [landmarks(x) for x in found]
        key = np.concatenate([k for k, _ in marks]) if marks else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(key))
        self.mark = np.concatenate([k << 32 | (p + MIDDLE) for k, (_, p) in enumerate(marks)] or [key])[order]  # query, place

    def votes(self, x: np.ndarray, least_overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, offsets and their votes, in order; votes for offsets with too little overlap go to the nearest one with enough."""
        key, place = landmarks(x)
        at = np.searchsorted(self.key, key)
        hit = np.flatnonzero(self.key.take(at, mode="clip") == key) if len(self.key) else at[:0]
        at, place = at[hit], place[hit]
        lo = self.first[at]
        n = self.first[at + 1] - lo
        codes, votes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # a sound that returns again and again meets itself very often: count such hits in runs
        for run in runs_of(n, MOST_HITS) if len(n) else []:
            m = n[run]
            code = self.mark[np.repeat(lo[run] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
            code -= np.repeat(place[run], m)
            code.sort()
            first = firsts(code)
            codes.append(code[first])
            votes.append(np.diff(first, append=len(code)))
        code, votes = codes[-1], votes[-1] if len(codes) <= 2 else np.concatenate(votes)
        if len(codes) > 2:
            code, back = np.unique(np.concatenate(codes), return_inverse=True)
            votes = np.bincount(back, votes, len(code)).astype(np.int64)
        owner, offset = code >> 32, (code & 0xFFFFFFFF) - MIDDLE
        few, many = least_overlap - len(x), (self.size - least_overlap)[owner]
        if few > 0 or (many < few).any():
            fits = many >= few
            owner, offset, votes, many = owner[fits], offset[fits], votes[fits], many[fits]
        offset = np.minimum(np.maximum(offset, few), many)
        first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1]))[: len(owner)])
        if len(first) < len(owner):
            owner, offset, votes = owner[first], offset[first], np.add.reduceat(votes, first)
        return owner, offset, votes

    def offsets(self, x: np.ndarray, least_overlap: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries and offsets, the OFFSETS of most votes of each query (of equal votes the smaller offsets), in order."""
        owner, offset, votes = self.votes(x, least_overlap)
        if len(owner) <= OFFSETS or not (owner[OFFSETS:] == owner[:-OFFSETS]).any():
            return owner, offset
        least, most = int(offset.min()), int(votes.max())
        a, b = int(offset.max() - least).bit_length(), most.bit_length()
        first = firsts(owner)
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(first, append=len(owner)))
        kept = rank < OFFSETS  # an owner has as many places in the order below as here
        if len(self.size).bit_length() + a + b < 63:
            ranked = np.sort(owner << (a + b) | (most - votes) << a | (offset - least))[kept]
            owner, offset = ranked >> (a + b), ranked & ((1 << a) - 1)
            code = np.sort(owner << a | offset)
            return code >> a, (code & ((1 << a) - 1)) + least
        chosen = np.sort(np.lexsort((offset, -votes, owner))[kept])
        return owner[chosen], offset[chosen]

    def errors(self, x: np.ndarray, place: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Bits that differ between ``n`` integers of the block from ``place`` on and of x from ``at`` on: in steps of STEP integers, the last one cut."""
        out = np.zeros(len(n), np.int64)
        other, every = windows(x), -(-n // STEP)
        for run in runs_of(every, STEPS_AT_ONCE) if len(n) else []:
            steps = every[run]
            start = np.cumsum(steps) - steps
            done = (np.arange(steps.sum()) - np.repeat(start, steps)) * STEP
            differ = self.windows[np.repeat(place[run], steps) + done].view(np.uint64)
            differ ^= other[np.repeat(at[run], steps) + done].view(np.uint64)
            differ &= HEADS[np.minimum(np.repeat(n[run], steps) - done, STEP)].view(np.uint64)
            # eight counts of at most 64 in a value: their sum
            count = np.bitwise_count(differ).view(np.uint64)
            count = (count & PAIRS) + (count >> np.uint64(8) & PAIRS)
            count *= ONES
            count >>= np.uint64(48)
            out[run] = np.add.reduceat(count.view(np.int64), start)
        return out

    def aligned(self, x: np.ndarray, most_errors: float, least_overlap: int, own: int | None = None) -> Links:
        """Every aligned query other than ``own`` at its best offset, by queries."""
        owner, offset = self.offsets(x, least_overlap)
        i, j = np.maximum(offset, 0), np.maximum(-offset, 0)
        n = np.minimum(self.size[owner] - i, len(x) - j)
        keep = n >= max(1, least_overlap)
        if own is not None:
            keep &= self.names[owner] != own
        if not keep.all():
            owner, offset, i, j, n = owner[keep], offset[keep], i[keep], j[keep], n[keep]
        errors = self.errors(x, self.start[owner] + i, j, n)
        near = np.flatnonzero(errors <= most_errors * 32 * n)
        owner, offset, n, rate = owner[near], offset[near], n[near], errors[near] / (32.0 * n[near])
        first = firsts(owner)
        # the smallest rate of a query, of equal ones the longest overlap, then the smallest offset
        for best, k in ((np.minimum, 0), (np.maximum, 1)):
            if len(first) < len(owner):
                worth = (rate, n)[k]
                keep = np.flatnonzero(worth == np.repeat(best.reduceat(worth, first), np.diff(first, append=len(owner))))
                owner, offset, n, rate = owner[keep], offset[keep], n[keep], rate[keep]
                first = firsts(owner)
        return Links(rate[first], n[first], self.names[owner[first]], offset[first])


def landmarks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of four consecutive integers, if it isn't the same in all, as a key with the byte's number, and its place.

    A byte of few filters outlives noise that the whole integer doesn't.
    """
    if len(x) < 4:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lanes = x.astype("<u4").view(np.uint8).reshape(-1, 4).T.astype(np.int64)
    key = lanes[:, :-3] << 24 | lanes[:, 1:-2] << 16 | lanes[:, 2:-1] << 8 | lanes[:, 3:]
    lane, at = np.nonzero(key != lanes[:, :-3] * 0x01010101)
    return key[lane, at] | lane << 32, at


def align(recordings: DataFrame, id_col: str, data_col: str, is_query, most_errors: float = MOST_ERRORS, least_overlap: int = WIDTH, block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """Rows (id, n_items, class_id, match, match_offset, overlap, bit_error_rate, matches) for every recording.

    class_id is the smallest id with an equal fingerprint (its own id where there
    is none).  match is the id of the query class (``is_query`` of a column of
    ids; a class is named by its smallest query) that the recording is aligned
    with over ``least_overlap`` integers or more at the smallest bit error rate up
    to ``most_errors``; longer overlaps, then smaller ids win ties.  A recording
    in a query's class matches it at offset 0 without errors.  match_offset is
    the recording's first integer's place in the match.  matches, on the rows whose
    id is the class_id, has every other query class that the class is aligned with
    within the limits, at the best of the OFFSETS offsets of most votes, best first; classes with a query
    have theirs as well.

    Query classes go to the executors in blocks of about ``block_bytes`` of fingerprints.  Recordings
    are gathered by class, and a class is held against every block once for all its recordings that a task has in a row;
    its links leave the worker as one array, at most MOST_LINKS of them or those of one recording at a time, and are
    never shuffled.

    A short recording is played again until it has WIDTH integers (see
    :func:`fingerprint`).  Null recordings and those without a sample have no
    integers and no match.  Null ids are never queries.  Of equally good matches the
    smaller id is taken.  Repeated rows stay.  Other columns are ignored, whatever
    their names.  An empty table gives an empty result.
    """
    spark = recordings.sparkSession
    prints = stage(fingerprints(recordings, id_col, data_col, **options), "fingerprints")
    known = prints.where("class is not null")
    asked = stage(known.where(is_query(F.col("id"))).groupBy("class").agg(F.min("id").alias("query"), F.first("items").alias("items")), "queries")
    # a table of its own, so that the join below is one of two exchanges, where a class with very many recordings is dealt to several tasks
    classes = stage(known.groupBy("class").agg(F.min("id").alias("class_id"), F.min(F.when(is_query(F.col("id")), F.col("id"))).alias("query")), "classes")
    size, n_queries = asked.agg(F.coalesce(F.sum(F.length("items") + 40), F.lit(0)), F.count("*")).first()
    n_blocks = max(1, -(-size // block_bytes))
    blocks = []
    for b in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("class"), F.lit(n_blocks)) == b).select("query", "items").orderBy("query").toArrow()
        blocks.append(spark.sparkContext.broadcast((rows.column(0).to_pylist(), rows.column(1).to_pylist())))
    step = max(1, MOST_LINKS // max(1, n_queries))

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: dict[int, QueryBlock] = {}
        before: dict[bytes, Links] = {}  # of the last class so far: more of its recordings may follow

        def block(b: int) -> QueryBlock:
            found = built.get(b) or QueryBlock(*blocks[b].value)
            if len(built) < KEPT_BLOCKS:
                built[b] = found
            return found

        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, sizes, prints, names, firsts, own = (part.column(k).to_pylist() for k in range(6))
                new = {c: (np.frombuffer(x, "<u4"), q, []) for c, x, q in zip(names, prints, own) if c not in before}
                for b in range(n_blocks if new else 0):
                    queries = block(b)
                    for x, q, found in new.values():
                        found.append(queries.aligned(x, most_errors, least_overlap, q))
                links = before | {c: in_order(found) for c, (_, _, found) in new.items()}
                before = {names[-1]: links[names[-1]]}
                yield _rows(ids, sizes, firsts, own, [links[c] for c in names])

    found = known.join(classes.hint("merge"), "class").select("id", "n_items", "items", "class", "class_id", "query").mapInArrow(run, ALIGNED)
    # recordings without integers have no class; they stay out of the join, where they would be one key
    without = prints.where("class is null").select("id", "n_items", F.col("id").alias("class_id"), *[F.lit(None).cast(t).alias(n) for n, t in (("match", "long"), ("match_offset", "long"), ("overlap", "long"), ("bit_error_rate", "double"), ("matches", MATCHES))])
    return found.union(without)


def _rows(ids: list, sizes: list, firsts: list, own: list, links: list[Links]) -> pa.RecordBatch:
    """Result rows of recordings, with the smallest ids of their classes, the queries that name these and their links."""
    best = [(q, 0, n, 0.0) if q is not None else (int(x.query[0]), int(x.offset[0]), int(x.overlap[0]), float(x.rate[0])) if len(x.rate) else (None,) * 4 for q, n, x in zip(own, sizes, links)]
    told = [i == c and len(x.rate) > 0 for i, c, x in zip(ids, firsts, links)]
    out = [x for x, t in zip(links, told) if t] or [Links(np.zeros(0), *[np.zeros(0, np.int64)] * 3)]
    ends = np.cumsum([0, *(len(x.rate) if t else 0 for x, t in zip(links, told))]).astype(np.int32)
    values = [np.concatenate(x) for x in zip(*((x.query, x.offset, x.overlap, x.rate) for x in out))]
    matches = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x) for x in values], ["match", "match_offset", "overlap", "bit_error_rate"]), mask=pa.array([not t for t in told], pa.bool_()))
    columns = [ids, sizes, firsts, *zip(*best)]
    types = [pa.int64()] * 6 + [pa.float64()]
    return pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(columns, types)), matches], ["id", "n_items", "class_id", "match", "match_offset", "overlap", "bit_error_rate", "matches"])
