"""Generalised additive model with pairwise interactions, for text quality.

Features are counts of a text, cut into quantile bins.  Training goes round the
features and fits a shallow tree on the bins of one feature to the gradient of
the logistic loss, adding its leaves to that feature's lookup table; then the
pairs of features whose best cross split reduces the remaining loss most get
tables of their own in the same way.  A score is the sum of looked-up values.

The model is fitted on the driver on at most ``max_rows`` labelled rows, taken
by a hash of their id; features are computed and every row is scored by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import Texts, chunks, trimmed
from .store import named
from .text_stats import text_stats

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 4
ROUNDS = 60
RATE = 0.2
FEATURES = ["log_words", "word_length", "symbols", "upper", "digits", "wide", "marks", "stops", "pipes", "lexical", "repeated", "distinct", "adjacent", "dup_lines", "line_words"]


def features(texts: Texts) -> np.ndarray:
    """A row of FEATURES for each text."""
    s = {k: v.astype(float) for k, v in text_stats(texts).items()}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["code_points"], 1), s["n_feeds"] + 1
    letters = np.maximum(s["n_upper"] + s["n_lower"], 1)
    return np.stack(
        [np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / words, s["n_upper"] / letters, s["n_digits"] / chars, s["n_wide"] / chars, s["n_marks"] / words, s["n_stops"] / words, s["n_pipes"] / words]
        + [s["n_lexical"] / words, s["n_repeat_words"] / words, s["n_distinct"] / words, s["n_adjacent"] / words, s["n_dup_lines"] / lines, np.log1p(s["n_words"] / lines)],
        axis=1,
    )


class Gam(NamedTuple):
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1) if len(x) else np.zeros((0, len(self.edges)), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for k, t in enumerate(self.tables):
            total += t[b[:, k]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            total += t[_coarse(b[:, i]), _coarse(b[:, j])]
        return 1 / (1 + np.exp(-total))


def _coarse(b: np.ndarray) -> np.ndarray:
    return b * PAIR_BINS // BINS


def _tree(g: np.ndarray, h: np.ndarray, depth: int, lam: float = 1.0) -> np.ndarray:
    """Leaf values by bin of a tree of up to ``depth`` levels on sums of gradients and curvatures by bin."""
    leaf = np.full(len(g), -g.sum() / (h.sum() + lam))
    if not depth or len(g) < 2:
        return leaf
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    rg, rh = g.sum() - cg, h.sum() - ch
    gain = cg**2 / (ch + lam) + rg**2 / (rh + lam)
    at = int(gain.argmax()) + 1
    if gain[at - 1] <= g.sum() ** 2 / (h.sum() + lam) + 1e-9:
        return leaf
    return np.concatenate([_tree(g[:at], h[:at], depth - 1, lam), _tree(g[at:], h[at:], depth - 1, lam)])


def _cross(g: np.ndarray, h: np.ndarray, lam: float = 1.0) -> tuple[float, np.ndarray]:
    """Best split of a grid into four by one cut on each axis: its gain and the leaf values."""
    sum2 = lambda a: np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    sg, sh = sum2(g), sum2(h)
    best, out, n = 0.0, np.zeros_like(g), len(g)
    i, j = np.meshgrid(np.arange(1, n), np.arange(1, n), indexing="ij")
    part = lambda s: [s[i, j], s[i, n] - s[i, j], s[n, j] - s[i, j], s[n, n] - s[i, n] - s[n, j] + s[i, j]]
    gains = sum(a**2 / (b + lam) for a, b in zip(part(sg), part(sh)))
    at = np.unravel_index(gains.argmax(), gains.shape)
    best = float(gains[at] - sg[n, n] ** 2 / (sh[n, n] + lam))
    a, b = at[0] + 1, at[1] + 1
    for rows in (slice(0, a), slice(a, n)):
        for cols in (slice(0, b), slice(b, n)):
            out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + lam)
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, n_pairs: int = PAIRS) -> Gam:
    """Fit on rows of features and labels 0 or 1; without rows every score is 0.5."""
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(width)]
    rate0 = (y.sum() + 1) / (len(y) + 2)
    model = Gam(edges, float(np.log(rate0 / (1 - rate0))), [np.zeros(BINS) for _ in edges], [], [])
    if not len(x):
        return model
    b = model.bins(x)
    total = np.full(len(x), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k in range(width):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[:, k], g, BINS), np.bincount(b[:, k], h, BINS), 2)
            model.tables[k][:] += step
            total += step[b[:, k]]
    c = np.stack([_coarse(b[:, k]) for k in range(width)], 1)

    def grid(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        at = c[:, i] * PAIR_BINS + c[:, j]
        return _cross(*(np.bincount(at, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in (g, h)))

    ranked = sorted(combinations(range(width), 2), key=lambda ij: -grid(*ij)[0])[:n_pairs]
    for ij in ranked:
        model.pairs.append(ij)
        model.pair_tables.append(np.zeros((PAIR_BINS, PAIR_BINS)))
    for _ in range(rounds // 2):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            step = rate * grid(i, j)[1]
            t += step
            total += step[c[:, i], c[:, j]]
    return model


def featured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column _features; a null text counts as empty."""
    docs = docs.withColumn(text_col, F.col(text_col).cast("string")).drop("_features")
    where, names = docs.columns.index(text_col), docs.columns

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(where)):
                x = features(texts)
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(texts.first, len(texts)).columns, values], [*names, "_features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", _features array<double>"
    return docs.mapInArrow(run, schema)


def held_out(id_col: str):
    """Whether a row is kept from training: crc32 of its id as text leaves no remainder by 5; a null id is."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> Gam:
    """Fit on labelled rows that aren't held out, at most about ``max_rows`` of them, taken by a hash of the id.

    Only their features are computed.  Labels other than 0 and 1 and null ids don't
    count; a row labelled twice counts twice; null texts are empty; without any row
    every score is 0.5.
    """
    lab = labels.select(F.col(f"`{named(labels, id_col)}`").cast("string").alias("_id"), F.col(f"`{named(labels, label_col)}`").cast("int").alias("_y")).where("_y in (0, 1)").where(~held_out("_id"))
    n = lab.count()
    lab = lab.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < F.lit(1_000_000 * max_rows // max(n, max_rows)))
    texts = docs.select(F.col(f"`{named(docs, id_col)}`").cast("string").alias("_id"), F.col(f"`{named(docs, text_col)}`").cast("string").alias("text"))
    # about max_rows ids, whatever the size of the table
    rows = featured(texts.join(F.broadcast(lab), "_id")).select("_id", "_features", "_y").toArrow()
    x = np.array(rows.column("_features").to_pylist(), float).reshape(-1, len(FEATURES))
    y = rows.column("_y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y, np.array(rows.column("_id").to_pylist(), str)))
    return fit(x[order], y[order])


def quality_classifier(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 if score >= ``threshold``).

    Inputs of a score are counts of the whole text alone, however long it is; equal
    texts have equal scores.  A null text counts as empty
    and is scored so.  Rows with a null id are held out.  Labels other than 0 and 1
    are ignored; without any every score is 0.5.  A repeated labelled row counts
    each time.  Other columns stay; columns named held_out, score or predicted
    are replaced.  An empty table gives an empty result.
    """
    docs = docs.drop("held_out", "score", "predicted")
    id_col, text_col = named(docs, id_col), named(docs, text_col)
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    model = train(docs, labels, label_col, id_col, text_col, max_rows)
    where, names = docs.columns.index(text_col), docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(where)):
                p = shared.value.score(features(texts))
                yield pa.RecordBatch.from_arrays([*batch.slice(texts.first, len(texts)).columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double, predicted int"
    return docs.mapInArrow(run, schema).withColumn("held_out", held_out(id_col))


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) of :func:`quality_classifier`, with its treatment of nulls, repeats and empty tables."""
    return quality_classifier(docs.select("doc_id", "text"), labels, **options).select("doc_id", "held_out", "score", "predicted")
