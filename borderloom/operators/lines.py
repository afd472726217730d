"""Linear referencing, cutting and deforming of lines.

Lines come as arrays of vertices and are worked on as segment rows
(id, pos, x0, y0, z0, x1, y1, z1, len, s0), s0 being the length before the
segment.  All of it is joins on the line's id and windows within a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from borderloom.functions.geometry import along, crossing_t, distance, point_segment, project_t

EPS = 1e-5


def segments(df: DataFrame, id_col: str = "line_id", geom: str = "geom") -> DataFrame:
    """Segment rows of lines, numbered from 0, with their abscissa."""
    g = F.col(geom)
    n = F.greatest(F.size(g) - 1, F.lit(0))
    rows = df.select(F.col(id_col).alias("id"), F.posexplode(F.arrays_zip(F.slice(g, 1, n).alias("a"), F.slice(g, 2, n).alias("b"))).alias("pos", "v"))
    s = rows.select("id", "pos", *[F.col(f"v.{e}.{c}").alias(f"{c}{k}") for k, e in enumerate("ab") for c in "xyz"])
    s = s.withColumn("len", distance("x0", "y0", "x1", "y1"))
    before = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("s0", F.coalesce(F.sum("len").over(before), F.lit(0.0)))


def lengths(segs: DataFrame) -> DataFrame:
    """Rows (id, n_segments, length)."""
    return segs.groupBy("id").agg(F.count("*").alias("n_segments"), F.sum("len").alias("length"))


def vertices(segs: DataFrame) -> DataFrame:
    """Rows (id, pos, x, y, z, s) of every vertex and its abscissa."""
    ends = segs.groupBy("id").agg(F.max_by(F.struct("pos", "x1", "y1", "z1", "s0", "len"), "pos").alias("e"))
    last = ends.select("id", (F.col("e.pos") + 1).alias("pos"), F.col("e.x1").alias("x"), F.col("e.y1").alias("y"), F.col("e.z1").alias("z"), (F.col("e.s0") + F.col("e.len")).alias("s"))
    return segs.select("id", "pos", F.col("x0").alias("x"), F.col("y0").alias("y"), F.col("z0").alias("z"), F.col("s0").alias("s")).union(last)


def _found(segs: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes (id, probe, s) with the segment that holds s: the first one up to s <= 0, else the first whose end reaches s, else the last."""
    ends = segs.withColumn("s1", F.col("s0") + F.col("len"))
    hit = probes.join(ends, "id")
    rank = F.struct(F.when((F.col("s1") >= F.col("s")) | (F.col("s") <= 0), F.col("pos")).otherwise(F.lit(2**31 - 1)), -F.col("pos"))
    return hit.groupBy("id", "probe", "s").agg(F.min_by(F.struct("pos", "x0", "y0", "z0", "x1", "y1", "z1", "len", "s0"), rank).alias("g"))


def locate(segs: DataFrame, probes: DataFrame) -> DataFrame:
    """Points (id, probe, s, pos, x, y, z) at abscissae, extended beyond the ends along the first and last segment; a segment without length gives its start."""
    f = _found(segs, probes).select("id", "probe", "s", "g.*")
    t = F.when(F.col("len") > 0, (F.col("s") - F.col("s0")) / F.col("len")).otherwise(F.lit(0.0))
    return f.select("id", "probe", "s", "pos", along("x0", "x1", t).alias("x"), along("y0", "y1", t).alias("y"), along("z0", "z1", t).alias("z"))


def project(segs: DataFrame, points: DataFrame) -> DataFrame:
    """Points (id, probe, px, py) on their lines: (id, probe, s, x, y, z, dist); of equally near segments the first."""
    j = points.join(segs, "id")
    t = project_t("px", "py", "x0", "y0", "x1", "y1")
    j = j.withColumn("t", t).withColumn("dist", distance("px", "py", along("x0", "x1", "t"), along("y0", "y1", "t")))
    at = F.struct((F.col("s0") + F.col("t") * F.col("len")).alias("s"), along("x0", "x1", "t").alias("x"), along("y0", "y1", "t").alias("y"), along("z0", "z1", "t").alias("z"), "dist")
    return j.groupBy("id", "probe").agg(F.min_by(at, F.struct("dist", "pos")).alias("m")).select("id", "probe", "m.*")


def sub_lines(segs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Vertices (id, probe, k, x, y, z) of the part from s_from to s_to, backwards if s_from is larger; inner vertices lie strictly between."""
    r = ranges.select("id", "probe", F.least("s_from", "s_to").alias("lo"), F.greatest("s_from", "s_to").alias("hi"), (F.col("s_from") > F.col("s_to")).alias("back"))
    ends = r.select("id", F.struct("probe", F.lit(0).alias("end")).alias("probe"), F.col("lo").alias("s")).union(r.select("id", F.struct("probe", F.lit(1).alias("end")).alias("probe"), F.col("hi").alias("s")))
    at = locate(segs, ends).select("id", F.col("probe.probe").alias("probe"), F.when(F.col("probe.end") == 0, F.lit(-1)).otherwise(F.lit(2**31 - 1)).alias("ord"), "x", "y", "z")
    inner = r.join(vertices(segs), "id").where((F.col("s") > F.col("lo")) & (F.col("s") < F.col("hi"))).select("id", "probe", F.col("pos").alias("ord"), "x", "y", "z")
    rows = at.union(inner).join(r.select("id", "probe", "back"), ["id", "probe"])
    order = Window.partitionBy("id", "probe").orderBy(F.when(F.col("back"), -F.col("ord")).otherwise(F.col("ord")))
    return rows.select("id", "probe", (F.row_number().over(order) - 1).alias("k"), "x", "y", "z")


def cuts_by_points(segs: DataFrame, points: DataFrame) -> DataFrame:
    """Cut abscissae (id, s) at the projections of points (id, probe, px, py)."""
    return project(segs, points).select("id", "s")


def cuts_by_segments(segs: DataFrame, cutters: DataFrame) -> DataFrame:
    """Cut abscissae (id, s) where segments (id, u0, v0, u1, v1) cross a line."""
    j = segs.join(cutters, "id")
    t = crossing_t("x0", "y0", "x1", "y1", "u0", "v0", "u1", "v1")
    u = crossing_t("u0", "v0", "u1", "v1", "x0", "y0", "x1", "y1")
    return j.select("id", "len", "s0", t.alias("t"), u.alias("u")).where("t between 0 and 1 and u between 0 and 1").select("id", (F.col("s0") + F.col("t") * F.col("len")).alias("s"))


def pieces(segs: DataFrame, cuts: DataFrame, precision: float = EPS) -> DataFrame:
    """Pieces (id, piece, s_from, s_to) of lines at cuts; cuts nearer than ``precision`` to an end or to the cut before don't count."""
    total = lengths(segs).select("id", "length")
    inner = cuts.join(total, "id").where((F.col("s") > precision) & (F.col("s") < F.col("length") - precision)).select("id", "s")
    w = Window.partitionBy("id").orderBy("s")
    apart = inner.withColumn("_gap", F.col("s") - F.lag("s").over(w)).where(F.col("_gap").isNull() | (F.col("_gap") > precision)).select("id", "s")
    marks = apart.union(total.select("id", F.lit(0.0).alias("s"))).union(total.select("id", F.col("length").alias("s")))
    return marks.select("id", (F.row_number().over(w) - 1).alias("piece"), F.col("s").alias("s_from"), F.lead("s").over(w).alias("s_to")).where("s_to is not null")


def trim(parts: DataFrame, at_start: bool) -> DataFrame:
    """What is left of each line without its first, or last, piece at a cut, and that piece: at most two rows (id, kept, s_from, s_to)."""
    w = Window.partitionBy("id")
    edge = F.min("piece").over(w) if at_start else F.max("piece").over(w)
    lone = F.count("*").over(w) == 1
    rows = parts.withColumn("kept", lone | (F.col("piece") != edge))
    return rows.groupBy("id", "kept").agg(F.min("s_from").alias("s_from"), F.max("s_to").alias("s_to"))


def truncate_ends(parts: DataFrame, total: DataFrame) -> DataFrame:
    """The part (id, s_from, s_to) between the first cut, if it lies in the first half, and the last cut, if it lies in the second."""
    j = parts.join(total, "id")
    first = F.min(F.when((F.col("piece") > 0) & (F.col("s_from") <= F.col("length") / 2), F.col("s_from")))
    last = F.max(F.when((F.col("s_to") < F.col("length")) & (F.col("s_to") >= F.col("length") / 2), F.col("s_to")))
    return j.groupBy("id", "length").agg(first.alias("a"), last.alias("b")).select("id", F.coalesce("a", F.lit(0.0)).alias("s_from"), F.coalesce("b", "length").alias("s_to"))


def deform(segs: DataFrame, moves: DataFrame, factor: float = 5.0, most: float = 30.0, snap: float = 1.0) -> DataFrame:
    """Vertices (id, s, x, y, z) of lines whose ends are moved by vectors (id, dx0, dy0, dx1, dy1).

    An end's move fades linearly over a reach of its length times ``factor``, at
    most ``most`` and the line's length.  A vertex is put in where a reach ends,
    unless one is within ``snap``.  Ends move by their whole vector.
    """
    total = lengths(segs).select("id", "length")
    norm = lambda a, b: F.sqrt(F.col(a) * F.col(a) + F.col(b) * F.col(b))
    m = moves.join(total, "id").withColumns({"r0": F.least(norm("dx0", "dy0") * factor, F.col("length"), F.lit(most)), "r1": F.least(norm("dx1", "dy1") * factor, F.col("length"), F.lit(most))})
    v = vertices(segs)
    limits = m.select("id", F.explode(F.array(F.struct(F.lit(0).alias("probe"), F.col("r0").alias("s"), F.col("r0").alias("r")), F.struct(F.lit(1).alias("probe"), (F.col("length") - F.col("r1")).alias("s"), F.col("r1").alias("r")))).alias("l"))
    limits = limits.select("id", "l.probe", "l.s", "l.r").where("r > 0")
    near = limits.join(v.select("id", F.col("s").alias("vs")), "id").groupBy("id", "probe", "s").agg(F.min(F.abs(F.col("vs") - F.col("s"))).alias("gap")).where(F.col("gap") > snap)
    added = locate(segs, near.select("id", "probe", "s")).select("id", "x", "y", "z", "s")
    every = v.select("id", "x", "y", "z", "s").union(added).join(m, "id")
    w0 = F.when(F.col("r0") > 0, F.greatest(F.lit(0.0), 1 - F.col("s") / F.col("r0"))).otherwise(F.lit(0.0))
    w1 = F.when(F.col("r1") > 0, F.greatest(F.lit(0.0), 1 - (F.col("length") - F.col("s")) / F.col("r1"))).otherwise(F.lit(0.0))
    at0, at1 = F.col("s") == 0, F.col("s") == F.col("length")
    moved = lambda c: F.when(at0, F.col(c) + F.col(f"d{c}0")).when(at1, F.col(c) + F.col(f"d{c}1")).otherwise(F.col(c) + w0 * F.col(f"d{c}0") + w1 * F.col(f"d{c}1"))
    return every.select("id", "s", moved("x").alias("x"), moved("y").alias("y"), "z")


def mean_line(segs_a: DataFrame, segs_b: DataFrame) -> DataFrame:
    """Vertices (id, rel, x, y, z) of the mean of two lines of one id, at the relative abscissae of the vertices of both."""
    rel = lambda s: vertices(s).join(lengths(s), "id").where("length > 0").select("id", F.round(F.col("s") / F.col("length"), 9).alias("rel"))
    both = rel(segs_a).union(rel(segs_b)).distinct()
    at = lambda s: locate(s, both.join(lengths(s), "id").select("id", F.col("rel").alias("probe"), (F.col("rel") * F.col("length")).alias("s"))).select("id", F.col("probe").alias("rel"), "x", "y", "z")
    a, b = at(segs_a), at(segs_b)
    mean = lambda c: ((a[c] + b[c]) / 2).alias(c)
    return a.join(b, ["id", "rel"]).select("id", "rel", mean("x"), mean("y"), F.coalesce((a["z"] + b["z"]) / 2, a["z"], b["z"]).alias("z"))


def hausdorff(segs_a: DataFrame, segs_b: DataFrame) -> DataFrame:
    """Distance (id, hausdorff) of two lines of one id: the largest distance of a vertex of either from the other."""

    def one_way(p: DataFrame, s: DataFrame) -> DataFrame:
        q = s.select("id", *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
        d = vertices(p).join(q, "id").withColumn("d", point_segment("x", "y", "_x0", "_y0", "_x1", "_y1"))
        return d.groupBy("id", "pos").agg(F.min("d").alias("d")).groupBy("id").agg(F.max("d").alias("d"))

    a, b = one_way(segs_a, segs_b), one_way(segs_b, segs_a)
    return a.join(b, "id").select("id", F.greatest(a["d"], b["d"]).alias("hausdorff"))


def z_from(sources: DataFrame, points: DataFrame) -> DataFrame:
    """z (id, probe, z) of points by their projections on one or more source lines (id, src, segment columns), averaged without NaN."""
    seg = sources.withColumn("line", F.struct("id", "src")).drop("id", "src")
    src = sources.select("id", "src").distinct()
    asked = points.join(src, "id").select(F.struct("id", "src").alias("id"), "probe", "px", "py")
    p = project(seg.withColumnRenamed("line", "id"), asked).where("z is not null and not isnan(z)")
    return p.groupBy(F.col("id.id").alias("id"), "probe").agg(F.avg("z").alias("z"))


def nearest_vertex(segs: DataFrame, points: DataFrame) -> DataFrame:
    """The nearest vertex (id, probe, pos) of each point's line; of equally near ones the first."""
    d = points.join(vertices(segs), "id").withColumn("d", distance("px", "py", "x", "y"))
    return d.groupBy("id", "probe").agg(F.min_by("pos", F.struct("d", "pos")).alias("pos"))
