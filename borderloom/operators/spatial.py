"""Spatial joins as equi-joins on grid cells.

Boxes are exploded into the cells they touch, cells are joined by equality, the
exact predicate follows, and a pair is kept in one cell alone: that of the
lower corner of what the two boxes share.  So there is neither a nested loop nor
a distinct over the pairs, and a crowded cell is split by AQE like any hot key.

Where the second table's boxes can be much larger than a cell (polygons, their
sides), each lies on a grid whose cells are doubled along either axis until it
spans three of them at most; the first table goes onto every such grid there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from borderloom.functions.geometry import crossing_t, distance, point_segment, segment_segment

CELL = 50.0


def boxed(df: DataFrame, kind: str) -> DataFrame:
    """``df`` with xmin, ymin, xmax, ymax of a point (x, y), a segment (x0, y0, x1, y1) or an array of vertices (ring)."""
    if kind == "point":
        return df.withColumns({"xmin": F.col("x"), "xmax": F.col("x"), "ymin": F.col("y"), "ymax": F.col("y")})
    if kind == "segment":
        return df.withColumns({"xmin": F.least("x0", "x1"), "xmax": F.greatest("x0", "x1"), "ymin": F.least("y0", "y1"), "ymax": F.greatest("y0", "y1")})
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    return df.withColumns({"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)})


def _cells(df: DataFrame, grow: float, cell: float) -> DataFrame:
    """A row for each cell that a box touches, its sides being ``cell`` doubled _lx and _ly times where the table has these."""
    size = {k: cell * F.pow(F.lit(2.0), f"_l{k}") if f"_l{k}" in df.columns else F.lit(cell) for k in "xy"}
    lo = lambda k: F.floor((F.col(f"{k}min") - grow) / size[k])
    hi = lambda k: F.floor((F.col(f"{k}max") + grow) / size[k])
    return df.withColumn("cx", F.explode(F.sequence(lo("x"), hi("x")))).withColumn("cy", F.explode(F.sequence(lo("y"), hi("y"))))


def box_join(a: DataFrame, b: DataFrame, within: float = 0.0, cell: float = CELL, how: str = "inner", sized: bool = False) -> DataFrame:
    """Pairs of rows of two boxed tables, no column in common but the boxes, whose boxes are ``within`` of each other on both axes; boxes are dropped.

    ``within`` widens the boxes of ``a`` alone.  ``sized``: boxes of ``b`` can be
    large, their grids follow their size (``b`` is read once more for the sizes).
    """
    box = ("xmin", "ymin", "xmax", "ymax")
    on = ["cx", "cy"]
    if sized:
        level = lambda k: F.greatest(F.lit(0), F.ceil(F.log2((F.col(f"{k}max") - F.col(f"{k}min")) / (2 * cell)))).cast("int").alias(f"_l{k}")
        grids = b.agg(F.collect_set(F.struct(level("x"), level("y"))).alias("l")).scalar()
        a = a.withColumn("_grids", grids).withColumn("_grid", F.explode("_grids")).select("*", "_grid.*").drop("_grids", "_grid")
        b = b.select("*", level("x"), level("y"))
        on += ["_lx", "_ly"]
    left = _cells(a, within, cell).select("*", *[F.col(c).alias(f"_a{c}") for c in box]).drop(*box)
    right = _cells(b, 0.0, cell).select("*", *[F.col(c).alias(f"_b{c}") for c in box]).drop(*box)
    j = left.join(right, on)
    meet = (
        (F.col("_bxmin") <= F.col("_axmax") + within) & (F.col("_bxmax") >= F.col("_axmin") - within)
        & (F.col("_bymin") <= F.col("_aymax") + within) & (F.col("_bymax") >= F.col("_aymin") - within)
    )
    corner = lambda c: F.floor(F.greatest(F.col(f"_a{c}min") - within, F.col(f"_b{c}min")) / (cell * F.pow(F.lit(2.0), f"_l{c}") if sized else cell))
    once = (F.col("cx") == corner("x")) & (F.col("cy") == corner("y"))
    return j.where(meet & once).drop(*on, *[f"_{s}{c}" for s in "ab" for c in box])


def points_near(a: DataFrame, b: DataFrame, most: float, cell: float = CELL) -> DataFrame:
    """Pairs (a_id, b_id, dist) of points (id, x, y) nearer than ``most``."""
    p = a.select(F.col("id").alias("a_id"), F.col("x").alias("ax"), F.col("y").alias("ay"), "x", "y")
    q = b.select(F.col("id").alias("b_id"), F.col("x").alias("bx"), F.col("y").alias("by"), "x", "y")
    j = box_join(boxed(p, "point").drop("x", "y"), boxed(q, "point").drop("x", "y"), most, max(cell, most))
    return j.withColumn("dist", distance("ax", "ay", "bx", "by")).where(F.col("dist") < most).select("a_id", "b_id", "dist")


def points_near_segments(points: DataFrame, segs: DataFrame, most: float, cell: float = CELL, sized: bool = False) -> DataFrame:
    """Pairs (p_id, s_id, dist) of points (id, x, y) and segments (id, x0, y0, x1, y1) nearer than ``most``; ``sized`` for segments much longer than a cell."""
    p = points.select(F.col("id").alias("p_id"), F.col("x").alias("px"), F.col("y").alias("py"), "x", "y")
    s = segs.select(F.col("id").alias("s_id"), "x0", "y0", "x1", "y1")
    j = box_join(boxed(p, "point").drop("x", "y"), boxed(s, "segment"), most, max(cell, most), sized=sized)
    return j.withColumn("dist", point_segment("px", "py", "x0", "y0", "x1", "y1")).where(F.col("dist") < most).select("p_id", "s_id", "dist")


def segments_near(a: DataFrame, b: DataFrame, most: float, cell: float = CELL, strict: bool = True) -> DataFrame:
    """Pairs (a_id, b_id, dist) of segments (id, x0, y0, x1, y1) nearer than ``most`` (or as near)."""
    p = a.select(F.col("id").alias("a_id"), "x0", "y0", "x1", "y1")
    q = boxed(b, "segment").select(F.col("id").alias("b_id"), F.col("x0").alias("u0"), F.col("y0").alias("v0"), F.col("x1").alias("u1"), F.col("y1").alias("v1"), "xmin", "ymin", "xmax", "ymax")
    j = box_join(boxed(p, "segment"), q, most, max(cell, most)).withColumn("dist", segment_segment("x0", "y0", "x1", "y1", "u0", "v0", "u1", "v1"))
    return j.where(F.col("dist") < most if strict else F.col("dist") <= most).select("a_id", "b_id", "dist")


def crossings(a: DataFrame, b: DataFrame, cell: float = CELL) -> DataFrame:
    """Points (a_id, b_id, t, u, x, y) where segments of ``a`` and ``b`` meet, t and u being the parameters on both."""
    p = a.select(F.col("id").alias("a_id"), "x0", "y0", "x1", "y1")
    q = boxed(b, "segment").select(F.col("id").alias("b_id"), F.col("x0").alias("u0"), F.col("y0").alias("v0"), F.col("x1").alias("u1"), F.col("y1").alias("v1"), "xmin", "ymin", "xmax", "ymax")
    j = box_join(boxed(p, "segment"), q, 0.0, cell)
    j = j.withColumn("t", crossing_t("x0", "y0", "x1", "y1", "u0", "v0", "u1", "v1")).withColumn("u", crossing_t("u0", "v0", "u1", "v1", "x0", "y0", "x1", "y1"))
    j = j.where("t between 0 and 1 and u between 0 and 1")
    return j.select("a_id", "b_id", "t", "u", F.expr("x0 + (x1 - x0) * t").alias("x"), F.expr("y0 + (y1 - y0) * t").alias("y"))


def best(pairs: DataFrame, by: str, other: str, value: str = "dist", digits: int = 9) -> DataFrame:
    """Of each ``by`` the pair of least rounded value; ties go to the smaller ``other``."""
    w = Window.partitionBy(by).orderBy(F.round(value, digits), other)
    return pairs.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def mutual_best(pairs: DataFrame, a: str = "a_id", b: str = "b_id", value: str = "dist", digits: int = 9) -> DataFrame:
    """Pairs that are best for both."""
    wa = Window.partitionBy(a).orderBy(F.round(value, digits), b)
    wb = Window.partitionBy(b).orderBy(F.round(value, digits), a)
    return pairs.withColumn("_ra", F.row_number().over(wa)).withColumn("_rb", F.row_number().over(wb)).where("_ra = 1 and _rb = 1").drop("_ra", "_rb")


def rings_of(polys: DataFrame, *keep: str) -> DataFrame:
    """A row (poly_id, keep, rings, xmin, ymin, xmax, ymax) a polygon: the segments (u0, v0, u1, v1) of all its closed rings in one array, and their box."""
    r = F.col("ring")
    pairs = F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda k: F.struct(*[F.element_at(r, k + d)[c].alias(f"{n}{d}") for d in (0, 1) for c, n in (("x", "u"), ("y", "v"))]))
    segs = F.when(F.size(r) > 1, pairs).otherwise(F.array().cast("array<struct<u0:double,v0:double,u1:double,v1:double>>"))
    one = boxed(polys.select("poly_id", *keep, "ring"), "ring").withColumn("rings", segs)
    return one.groupBy("poly_id", *keep).agg(F.flatten(F.collect_list("rings")).alias("rings"), *[(F.min if c.endswith("min") else F.max)(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Whether a point lies inside rings, by the even-odd rule: a ray to the right of it crosses an odd number of their segments."""

    def odd(r: Column) -> Column:
        spans = (r["v0"] > y) != (r["v1"] > y)
        return F.when(spans, x < r["u0"] + (y - r["v0"]) / (r["v1"] - r["v0"]) * (r["u1"] - r["u0"])).otherwise(F.lit(False))

    return F.size(F.filter(rings, odd)) % 2 == 1


def points_in(points: DataFrame, polys: DataFrame, cell: float = CELL) -> DataFrame:
    """Pairs (p_id, poly_id) of points (id, x, y) inside polygons (poly_id, ring), by the even-odd rule."""
    p = boxed(points.select(F.col("id").alias("p_id"), F.col("x").alias("px"), F.col("y").alias("py"), "x", "y"), "point").drop("x", "y")
    rings = rings_of(polys)
    near = box_join(p, rings.drop("rings"), 0.0, cell, sized=True).join(rings.select("poly_id", "rings"), "poly_id")
    return near.where(inside(F.col("px"), F.col("py"), F.col("rings"))).select("p_id", "poly_id")
