"""Planar networks as edge, vertex and half-edge tables.

A vertex is named by its coordinates on a rounded grid, so building a graph is an
aggregation, not a search.  Fixpoints are driver loops over equi-joins; every
round cuts the lineage by a reliable checkpoint and collects one number.
Components are found in blocks of neighbours first, so that the loop is left with
those that lie in several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from borderloom.functions.geometry import crossing_t, distance, point_segment, project_t
from borderloom.operators.spatial import box_join, boxed
from borderloom.sources.staging import cut

EDGE_TOLERANCE = 1e-5
#: links, or edges, that a worker takes at once; a component with more edges is still one block of faces
BLOCK = 200_000


def vertex_key(x: Column | str, y: Column | str, tolerance: float = EDGE_TOLERANCE) -> Column:
    """Name of a vertex: points of one grid cell of ``tolerance`` are one vertex."""
    k = lambda c: F.floor((F.col(c) if isinstance(c, str) else c) / tolerance + 0.5).cast("long").cast("string")
    return F.concat_ws(":", k(x), k(y))


def graph_edges(edges: DataFrame, tolerance: float = EDGE_TOLERANCE, id_col: str = "objectid") -> DataFrame:
    """``edges`` with v0, v1 and len; segments or the ends of lines are in x0, y0, x1, y1."""
    e = edges.withColumns({"v0": vertex_key("x0", "y0", tolerance), "v1": vertex_key("x1", "y1", tolerance)})
    return e if "len" in edges.columns else e.withColumn("len", distance("x0", "y0", "x1", "y1"))


def half_edges(g: DataFrame, id_col: str = "objectid", keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows (eid, dir, v, w, x, y, xw, yw, len, ...) an edge, from each of its ends."""
    rest = ["len", *keep]
    out = g.select(F.col(id_col).alias("eid"), F.lit(1).alias("dir"), F.col("v0").alias("v"), F.col("v1").alias("w"), F.col("x0").alias("x"), F.col("y0").alias("y"), F.col("x1").alias("xw"), F.col("y1").alias("yw"), *rest)
    back = g.select(F.col(id_col).alias("eid"), F.lit(-1).alias("dir"), F.col("v1").alias("v"), F.col("v0").alias("w"), F.col("x1").alias("x"), F.col("y1").alias("y"), F.col("x0").alias("xw"), F.col("y0").alias("yw"), *rest)
    return out.union(back)


def graph_vertices(h: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """Rows (v, degree, x, y, ...); a loop counts twice."""
    return h.groupBy("v").agg(F.count("*").alias("degree"), F.min("x").alias("x"), F.min("y").alias("y"), *(extra or []))


def origin_flags(origins: DataFrame) -> DataFrame:
    """Per edge of (eid, pos, origin, country, w_tag): whether any origin is a connecting line, the first origin's country and tag, and the set of single countries."""
    return origins.groupBy("eid").agg(
        F.bool_or(F.col("country").contains("#")).alias("is_cl"),
        F.min_by("country", "pos").alias("country"), F.min_by("w_tag", "pos").alias("w_tag"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("country", "#"))))).alias("countries"),
    )


def origin_for(origins: Column, countries: Column, country: Column | str) -> Column:
    """The origin of an edge for a country: the only one, else the first if its country matches, else the last."""
    c = F.lit(country) if isinstance(country, str) else country
    return F.when((F.size(origins) == 1) | (F.get(countries, F.lit(0)) == c), F.get(origins, F.lit(0))).otherwise(F.element_at(origins, -1))


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number of its component for each of 0 .. n - 1, by links a - b: larger roots are hung below smaller ones until none is left."""
    lab = np.arange(n)
    while len(a):
        lo, hi = np.minimum(lab[a], lab[b]), np.maximum(lab[a], lab[b])
        apart = lo != hi
        a, b = a[apart], b[apart]
        np.minimum.at(lab, hi[apart], lo[apart])
        while not np.array_equal(up := lab[lab], lab):
            lab = up
    return lab


def _ranks(*columns: pa.ChunkedArray) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct values of all columns in order, and the places of each column's values there."""
    wide = lambda t: pa.large_string() if pa.types.is_string(t) else t
    code = pa.concat_arrays([c.cast(wide(c.type)) for col in columns for c in col.chunks]).dictionary_encode()
    order = pc.sort_indices(code.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    at = rank[code.indices.to_numpy()]
    return code.dictionary.take(order), np.split(at, np.cumsum([len(c) for c in columns])[:-1])


def _block_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, root) of the components of each block of links (n, m)."""

    def found(block: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(block)
        names, (n, m) = _ranks(t["n"], t["m"])
        return pa.RecordBatch.from_arrays([c.cast(t["n"].type) for c in (names, names.take(pa.array(_least(len(names), n, m))))], names=["node", "root"])

    block, size = [], 0
    for batch in batches:
        block.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            yield found(block)
            block, size = [], 0
    if size:
        yield found(block)


def components(links: DataFrame, a: str = "a", b: str = "b", place: str | None = None) -> DataFrame:
    """Rows (node, root) of all nodes with a link; root is the smallest node of the component.

    With a column ``place`` in which neighbours are near each other (x), links are
    sorted by it and solved in blocks; what is left are links of the roots of nodes
    that are in several blocks.  Labels of neighbours are taken and then shortened
    by the label's own label, until nothing changes.
    """
    e = links.select(F.col(a).alias("n"), F.col(b).alias("m"), *([F.col(place).alias("p")] if place else [])).where("n is not null and m is not null")
    if place:
        kind = e.schema["n"].dataType.simpleString()
        parts = e.repartitionByRange("p").sortWithinPartitions("p").select("n", "m").mapInArrow(_block_components, f"node {kind}, root {kind}")
        held = cut(parts.groupBy("node").agg(F.array_sort(F.collect_set("root")).alias("roots")).select("node", F.get("roots", F.lit(0)).alias("root"), F.when(F.size("roots") > 1, F.slice("roots", 2, F.size("roots"))).alias("more")))
        glue = held.where("more is not null").select("root", F.explode("more").alias("other")).distinct()
        if not held.where("more is not null").limit(1).count():
            return held.select("node", "root")
        top = components(glue, "root", "other").select(F.col("node").alias("root"), F.col("root").alias("top"))
        return held.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    both = cut(e.union(e.select(F.col("m").alias("n"), F.col("n").alias("m"))).distinct())
    lab = both.groupBy("n").agg(F.least(F.min("m"), F.min("n")).alias("root"))
    lab = cut(lab.select(F.col("n").alias("node"), F.least("n", "root").alias("root")))
    while True:
        near = both.join(lab.withColumnRenamed("node", "m"), "m").groupBy(F.col("n").alias("node")).agg(F.min("root").alias("r"))
        step = lab.join(near, "node").select("node", F.least("root", "r").alias("new"), "root")
        up = step.select(F.col("node").alias("new"), F.col("new").alias("above"))
        after = cut(step.join(up, "new", "left").select("node", F.least("new", F.coalesce("above", "new")).alias("root"), (F.least("new", F.coalesce("above", "new")) != F.col("root")).alias("moved")))
        moved = after.where("moved").limit(1).count()
        lab = after.select("node", "root")
        if not moved:
            return lab


def chains(g: DataFrame, key: Column | None = None, id_col: str = "objectid", stops: DataFrame | None = None) -> DataFrame:
    """Rows (eid, chain, n_edges, length, pivot): edges joined through vertices of degree 2 at which both have an equal key, but not through ``stops`` (v).

    A chain is named by its smallest edge; the pivot is its longest edge, the
    smaller id of equal ones.  Loops are chains of their own.
    """
    k = F.lit(0) if key is None else key
    h = half_edges(g.withColumn("_key", k).where("v0 <> v1"), id_col, ("_key",))
    two = h.groupBy("v").agg(F.count("*").alias("degree"), F.min("eid").alias("a"), F.max("eid").alias("b"), F.min("_key").alias("ka"), F.max("_key").alias("kb"), F.min("x").alias("x"))
    loops = g.where("v0 = v1").select(F.col("v0").alias("v")).distinct()
    links = two.where("degree = 2 and a <> b and ka <=> kb").join(loops, "v", "left_anti")
    if stops is not None:
        links = links.join(stops.select("v"), "v", "left_anti")
    lab = components(links, "a", "b", "x")
    named = g.select(F.col(id_col).alias("eid"), "len").join(lab, F.col("eid") == F.col("node"), "left").select("eid", "len", F.coalesce("root", "eid").alias("chain"))
    total = named.groupBy("chain").agg(F.count("*").alias("n_edges"), F.sum("len").alias("length"), F.min_by("eid", F.struct(-F.round("len", 9), "eid")).alias("pivot"))
    return named.select("eid", "chain").join(total, "chain").select("eid", "chain", "n_edges", "length", "pivot")


def chain_ends(g: DataFrame, ch: DataFrame, id_col: str = "objectid") -> DataFrame:
    """The two ends (chain, v, eid) of each chain that isn't a ring: its vertices that only one of its half-edges has."""
    h = half_edges(g, id_col).join(ch.select("eid", "chain"), "eid")
    return h.groupBy("chain", "v").agg(F.count("*").alias("n"), F.min("eid").alias("eid")).where("n = 1").drop("n")


def chain_positions(g: DataFrame, ch: DataFrame, begin: DataFrame, id_col: str = "objectid") -> DataFrame:
    """Rows (chain, eid, pos) of the edges of chains that begin at a vertex (chain, v), numbered from 0 there.

    Each half-edge points at the next one of its chain; pointers are doubled, so a
    chain of n edges takes about log n rounds and is never gathered.
    """
    members = ch.select("eid", "chain").join(begin.select("chain"), "chain", "left_semi")
    h = half_edges(g, id_col).join(members, "eid").select("chain", "eid", "dir", "v", "w")
    # walk towards the beginning: from each half-edge to the one of another edge that leaves its end
    on = h.select("chain", F.col("v").alias("w"), F.col("eid").alias("e2"), F.col("dir").alias("d2"))
    at = begin.select("chain", F.col("v").alias("w"), F.lit(True).alias("home"))
    link = h.join(at, ["chain", "w"], "left").join(on, ["chain", "w"], "left").where("home or e2 is null or e2 <> eid")
    link = link.groupBy("chain", "eid", "dir").agg(F.max(F.coalesce("home", F.lit(False))).alias("home"), F.min(F.when(F.col("e2") != F.col("eid"), F.struct("e2", "d2"))).alias("n"))
    step = cut(link.select("chain", "eid", "dir", "home", F.when(~F.col("home"), F.col("n")).alias("n"), F.lit(0).alias("pos")))
    while True:
        up = step.select("chain", F.struct(F.col("eid").alias("e2"), F.col("dir").alias("d2")).alias("n"), F.col("n").alias("_n"), F.col("home").alias("_home"), F.col("pos").alias("_pos"))
        j = step.join(up, ["chain", "n"], "left")
        after = cut(j.select("chain", "eid", "dir", (F.col("home") | F.coalesce("_home", F.lit(False))).alias("home"), F.col("_n").alias("n"), (F.col("pos") + F.when(F.col("_pos").isNull(), 0).otherwise(F.col("_pos") + 1)).alias("pos")))
        if not after.where("n is not null").limit(1).count():
            return after.where("home").groupBy("chain", "eid").agg(F.min("pos").alias("pos"))
        step = after


def antennas(g: DataFrame, key: Column | None = None, id_col: str = "objectid") -> DataFrame:
    """Dangling chains (chain, tip, base, n_edges, length): from a vertex of degree 1 to the first that isn't of degree 2 (or where the key changes).

    A chain with two free ends is given from the smaller one.
    """
    ch = chains(g, key, id_col)
    deg = graph_vertices(half_edges(g, id_col)).select("v", "degree")
    ends = chain_ends(g, ch, id_col).join(deg, "v")
    two = ends.groupBy("chain").agg(F.min_by("v", F.struct("degree", "v")).alias("tip"), F.max_by("v", F.struct("degree", "v")).alias("base"), F.min("degree").alias("least"))
    return two.where("least = 1").join(ch.select("chain", "n_edges", "length").distinct(), "chain").select("chain", "tip", "base", "n_edges", "length")


def merge_vertices(g: DataFrame, mapping: DataFrame) -> DataFrame:
    """``g`` with the ends of its edges on vertices (old, new) of the mapping; transitive mappings must be closed."""
    m0 = mapping.select(F.col("old").alias("v0"), F.col("new").alias("n0"))
    m1 = mapping.select(F.col("old").alias("v1"), F.col("new").alias("n1"))
    return g.join(m0, "v0", "left").join(m1, "v1", "left").select(*[F.coalesce("n0", "v0").alias("v0") if c == "v0" else F.coalesce("n1", "v1").alias("v1") if c == "v1" else F.col(c) for c in g.columns])


def closure(mapping: DataFrame) -> DataFrame:
    """Transitive closure of an acyclic map (old, new): each old with the last new of its chain, by doubling."""
    m = cut(mapping.select("old", "new"))
    while True:
        up = m.select(F.col("old").alias("new"), F.col("new").alias("above"))
        after = cut(m.join(up, "new", "left").select("old", F.coalesce("above", "new").alias("new"), F.col("above").isNotNull().alias("moved")))
        moved = after.where("moved").limit(1).count()
        m = after.select("old", "new")
        if not moved:
            return m


def translate_vertices(vertices: DataFrame, moves: DataFrame) -> DataFrame:
    """Vertices (v, x, y, ...) with the mean of their displacements (v, dx, dy)."""
    mean = moves.groupBy("v").agg(F.avg("dx").alias("_dx"), F.avg("dy").alias("_dy"))
    out = vertices.join(mean, "v", "left")
    add = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0.0))).alias(c)
    return out.select(*[add("x", "_dx") if c == "x" else add("y", "_dy") if c == "y" else F.col(c) for c in vertices.columns])


def planarize(segs: DataFrame, scale: float = 1e5, cell: float = 50.0) -> DataFrame:
    """Sub-edges (v0, v1, x0, y0, x1, y1, origins) of segments (id, x0, y0, x1, y1) cut at all their crossings and rounded to a grid of 1 / scale.

    A segment is also cut at ends of others that lie on it, so that overlapping
    segments share their overlap.  Equal sub-edges, whatever their direction, are
    one with all their origins.
    """
    end = ("x0", "y0", "x1", "y1")
    near = 0.5 / scale
    other = boxed(segs.select(F.col("id").alias("other"), *end), "segment").withColumnsRenamed(dict(zip(end, ("u0", "v0", "u1", "v1"))))
    j = box_join(boxed(segs.select("id", *end), "segment"), other, near, cell).where("id <> other").drop("other")
    j = j.withColumns({"t": crossing_t(*end, "u0", "v0", "u1", "v1"), "u": crossing_t("u0", "v0", "u1", "v1", *end)})
    hit = [F.when(F.expr("t between 0 and 1 and u between 0 and 1"), F.col("t"))]
    hit += [F.when(point_segment(f"u{k}", f"v{k}", *end) < near, project_t(f"u{k}", f"v{k}", *end)) for k in (0, 1)]
    hits = j.select("id", *end, F.explode(F.array(*hit)).alias("t")).where("t is not null")
    marks = hits.union(segs.select("id", *end, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("t")))
    snap = lambda c: (F.floor(c * scale + 0.5) / scale)
    marks = marks.select("id", "t", snap(F.expr("x0 + (x1 - x0) * t")).alias("x"), snap(F.expr("y0 + (y1 - y0) * t")).alias("y"))
    # dealt by id once, for the places of a segment and for their order
    marks = marks.repartition("id").groupBy("id", "x", "y").agg(F.min("t").alias("t"))
    w = Window.partitionBy("id").orderBy("t")
    part = marks.select("id", "x", "y", F.lead("x").over(w).alias("xn"), F.lead("y").over(w).alias("yn")).where("xn is not null")
    first = F.struct("x", "y") <= F.struct(F.col("xn").alias("x"), F.col("yn").alias("y"))
    a, b = F.when(first, F.struct("x", "y")).otherwise(F.struct(F.col("xn").alias("x"), F.col("yn").alias("y"))), F.when(first, F.struct(F.col("xn").alias("x"), F.col("yn").alias("y"))).otherwise(F.struct("x", "y"))
    sub = part.select(a.alias("a"), b.alias("b"), "id").groupBy("a", "b").agg(F.array_sort(F.collect_set("id")).alias("origins"))
    out = sub.select(F.col("a.x").alias("x0"), F.col("a.y").alias("y0"), F.col("b.x").alias("x1"), F.col("b.y").alias("y1"), "origins")
    return out.withColumns({"v0": vertex_key("x0", "y0", 1 / scale), "v1": vertex_key("x1", "y1", 1 / scale)}).where("v0 <> v1")


def induced(sub: DataFrame) -> DataFrame:
    """Rows (origin, v0, v1) of the sub-edges that a feature runs through."""
    return sub.select(F.explode("origins").alias("origin"), "v0", "v1", "x0", "y0", "x1", "y1")


FACES = "root string, face_id string, ord int, eid string, dir int, v string, w string, x double, y double, xw double, yw double, len double, area double"


def _walk(t: pa.Table) -> pa.RecordBatch:
    """Faces of whole components, edges in the order of their roots: at a vertex the walk goes on with the next half-edge clockwise."""
    n = t.num_rows
    root = t["root"].combine_chunks()
    piece = np.r_[0, np.cumsum(np.array(pc.not_equal(root[1:], root[:-1])))] if n > 1 else np.zeros(1, int)
    names, (v0, v1) = _ranks(t["v0"], t["v1"])
    _, (eid,) = _ranks(t["eid"])
    x0, y0, x1, y1 = (t[c].to_numpy() for c in ("x0", "y0", "x1", "y1"))
    both = lambda a, b: np.concatenate([a, b])
    v, w, x, y, xw, yw = both(v0, v1), both(v1, v0), both(x0, x1), both(y0, y1), both(x1, x0), both(y1, y0)
    way = np.repeat([1, -1], n)
    order = np.lexsort((way, both(eid, eid), np.arctan2(yw - y, xw - x), v, both(piece, piece)))
    place = np.empty(2 * n, int)
    place[order] = np.arange(2 * n)
    edge, v, w, x, y, xw, yw, way = order % n, v[order], w[order], x[order], y[order], xw[order], yw[order], way[order]
    piece = piece[edge]
    back = place[(order + n) % (2 * n)]
    new = np.r_[True, (v[1:] != v[:-1]) | (piece[1:] != piece[:-1])]
    group = np.cumsum(new) - 1
    first, size = np.flatnonzero(new)[group], np.bincount(group)[group]
    at = first[back]
    after = at + (back - at - 1) % size[back]
    # the first half-edge of each cycle of ``after``, and the steps to it, by doubling
    lead, step = np.arange(2 * n), after
    while not np.array_equal(lead[after], lead):
        lead, step = np.minimum(lead, lead[step]), step[step]
    begin = lead == np.arange(2 * n)
    steps, step = np.where(begin, 0, 1), np.where(begin, np.arange(2 * n), after)
    while not np.array_equal(step, lead):
        steps, step = steps + steps[step], step[step]
    face = (np.cumsum(begin) - 1)[lead]
    ring = np.bincount(face)[face]
    area = (pd.Series(x * yw - y * xw).groupby(face).sum() / 2).to_numpy()[face]
    number = face - face[np.searchsorted(piece, piece)]
    root, text = root.take(pa.array(edge)), lambda a: a.cast(pa.string())
    columns = [
        root, pc.binary_join_element_wise(root, text(pa.array(number)), "/"), pa.array(((ring - steps) % ring).astype(np.int32)), t["eid"].combine_chunks().take(pa.array(edge)), pa.array(way.astype(np.int32)),
        text(names.take(pa.array(v))), text(names.take(pa.array(w))), *map(pa.array, (x, y, xw, yw, t["len"].to_numpy()[edge], area)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FACES.split(", ")])


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_walk` of edges sorted by root, as many whole components at once as make a block."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < BLOCK:
            continue
        t = pa.Table.from_batches(held)
        whole = pc.index(t["root"], t["root"][-1]).as_py()
        if whole:
            yield _walk(t.slice(0, whole))
            t = t.slice(whole)
            held, size = t.to_batches(), t.num_rows
    if size:
        yield _walk(pa.Table.from_batches(held))


def faces(g: DataFrame, id_col: str = "objectid") -> DataFrame:
    """Half-edges in face order (root, face_id, ord, eid, dir, v, w, x, y, xw, yw, len, area), whole components of the graph at a time.

    Inner faces have a positive area, the outer one of a component a negative or
    none.  This is the one place that gathers a component in a task; a component
    is a connected piece of network, which must fit there.
    """
    g = g.select(F.col(id_col).cast("string").alias("eid"), "v0", "v1", "x0", "y0", "x1", "y1", "len")
    lab = components(g, "v0", "v1", "x0")
    e = g.join(lab.withColumnRenamed("node", "v0"), "v0").repartition("root").sortWithinPartitions("root")
    return e.select("root", "eid", "v0", "v1", "x0", "y0", "x1", "y1", "len").mapInArrow(_walks, FACES)


def country_paths(contour: DataFrame, break_at: Column) -> DataFrame:
    """Face contours (face_id, ord, country, ...) cut into runs of one country that end at breaking vertices: adds path, numbered from 0.

    The last run goes on as the first if the contour's start is no break and the
    countries agree.
    """
    w = Window.partitionBy("face_id").orderBy("ord")
    new = (F.lag("country").over(w) != F.col("country")) | break_at
    runs = contour.withColumn("_new", F.when(F.row_number().over(w) == 1, 0).otherwise(new.cast("int"))).withColumn("_at_start", (F.row_number().over(w) == 1) & break_at)
    runs = runs.withColumn("path", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("face_id")
    wrap = (F.max("path").over(whole) > 0) & (F.first("country").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == F.last("country").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))) & ~F.max("_at_start").over(whole)
    return runs.withColumn("path", F.when(wrap & (F.col("path") == F.max("path").over(whole)), 0).otherwise(F.col("path"))).drop("_new", "_at_start")


def shortest_paths(g: DataFrame, sources: DataFrame, most: float, id_col: str = "objectid") -> DataFrame:
    """Rows (source, v, dist) of the least distances up to ``most`` from source vertices, by rounds of relaxation."""
    h = cut(half_edges(g, id_col).groupBy("v", "w").agg(F.min("len").alias("len")))
    best = cut(sources.select(F.col("v").alias("source"), "v", F.lit(0.0).alias("dist")))
    front = best
    while True:
        step = front.join(h, "v").select("source", F.col("w").alias("v"), (F.col("dist") + F.col("len")).alias("dist")).where(F.col("dist") <= most)
        step = step.groupBy("source", "v").agg(F.min("dist").alias("new"))
        better = cut(step.join(best, ["source", "v"], "left").where("dist is null or new < dist - 1e-9").select("source", "v", F.col("new").alias("dist")))
        if not better.limit(1).count():
            return best
        best = cut(best.join(better.select("source", "v"), ["source", "v"], "left_anti").union(better))
        front = better
