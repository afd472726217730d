"""Planar geometry as column expressions, all inside whole-stage codegen.

A point is a pair of columns, a segment two of them.  Columns may be given by name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distance(ax: C, ay: C, bx: C, by: C) -> Column:
    dx, dy = col(bx) - col(ax), col(by) - col(ay)
    return F.sqrt(dx * dx + dy * dy)


def distance3d(ax: C, ay: C, az: C, bx: C, by: C, bz: C) -> Column:
    dx, dy, dz = col(bx) - col(ax), col(by) - col(ay), col(bz) - col(az)
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def clamp01(t: C) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), col(t)))


def project_t(px: C, py: C, x0: C, y0: C, x1: C, y1: C) -> Column:
    """Parameter in [0, 1] of the closest point of a segment; 0 on a segment without length."""
    dx, dy = col(x1) - col(x0), col(y1) - col(y0)
    n = dx * dx + dy * dy
    t = ((col(px) - col(x0)) * dx + (col(py) - col(y0)) * dy) / n
    return F.when(n > 0, clamp01(t)).otherwise(F.lit(0.0))


def along(a: C, b: C, t: C) -> Column:
    return col(a) + (col(b) - col(a)) * col(t)


def point_segment(px: C, py: C, x0: C, y0: C, x1: C, y1: C) -> Column:
    t = project_t(px, py, x0, y0, x1, y1)
    return distance(px, py, along(x0, x1, t), along(y0, y1, t))


def cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx


def crossing_t(x0: C, y0: C, x1: C, y1: C, u0: C, v0: C, u1: C, v1: C) -> Column:
    """Parameter on the first segment's line where it meets the second's; null for parallel lines."""
    dx, dy = col(x1) - col(x0), col(y1) - col(y0)
    ex, ey = col(u1) - col(u0), col(v1) - col(v0)
    den = cross(dx, dy, ex, ey)
    return F.when(den != 0, cross(col(u0) - col(x0), col(v0) - col(y0), ex, ey) / den)


def segments_meet(x0: C, y0: C, x1: C, y1: C, u0: C, v0: C, u1: C, v1: C) -> Column:
    """Whether two segments that aren't parallel have a point in common, ends included."""
    t = crossing_t(x0, y0, x1, y1, u0, v0, u1, v1)
    u = crossing_t(u0, v0, u1, v1, x0, y0, x1, y1)
    return F.coalesce(t.between(0, 1) & u.between(0, 1), F.lit(False))


def segment_segment(x0: C, y0: C, x1: C, y1: C, u0: C, v0: C, u1: C, v1: C) -> Column:
    """Distance of two segments."""
    ends = F.least(
        point_segment(x0, y0, u0, v0, u1, v1), point_segment(x1, y1, u0, v0, u1, v1),
        point_segment(u0, v0, x0, y0, x1, y1), point_segment(u1, v1, x0, y0, x1, y1),
    )
    return F.when(segments_meet(x0, y0, x1, y1, u0, v0, u1, v1), F.lit(0.0)).otherwise(ends)


def angle(ax: C, ay: C, bx: C, by: C) -> Column:
    """Angle of two vectors in radians, 0 to pi; null if one has no length."""
    n = F.sqrt(col(ax) * col(ax) + col(ay) * col(ay)) * F.sqrt(col(bx) * col(bx) + col(by) * col(by))
    c = (col(ax) * col(bx) + col(ay) * col(by)) / n
    return F.when(n > 0, F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), c))))


def point(x: C, y: C, z: C | None = None) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"), (F.lit(0.0) if z is None else col(z).cast("double")).alias("z"))


def array_length(geom: C) -> Column:
    """Length in the plane of an array of vertices, within the row."""
    g = col(geom)
    pairs = F.arrays_zip(F.slice(g, 1, F.greatest(F.size(g) - 1, F.lit(0))).alias("a"), F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(0))).alias("b"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + distance(p["a"]["x"], p["a"]["y"], p["b"]["x"], p["b"]["y"]))


def ring_area(geom: C) -> Column:
    """Signed area of a closed ring of vertices (shoelace)."""
    g = col(geom)
    pairs = F.arrays_zip(F.slice(g, 1, F.greatest(F.size(g) - 1, F.lit(0))).alias("a"), F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(0))).alias("b"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"])) / 2


def mean_width(geom: C) -> Column:
    """Twice the area of a ring over its length."""
    return 2 * F.abs(ring_area(geom)) / array_length(geom)


def reverse(geom: C) -> Column:
    return F.reverse(col(geom))


def with_z(geom: C, z: float | None) -> Column:
    """The vertices with another z; None clears it."""
    return F.transform(col(geom), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(z).cast("double").alias("z")))


def fill_z(geom: C, z: float = 0.0) -> Column:
    """The vertices with ``z`` where theirs is null or NaN."""
    return F.transform(col(geom), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.when(p["z"].isNull() | F.isnan(p["z"]), F.lit(z)).otherwise(p["z"]).alias("z")))


def set_point(geom: C, at: int, x: C, y: C) -> Column:
    """The vertices with vertex ``at`` (from 0, negative from the end) moved, its z kept."""
    g = col(geom)
    place = F.lit(at) if at >= 0 else F.size(g) + at
    return F.transform(g, lambda p, k: F.when(k == place, F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"), p["z"].alias("z"))).otherwise(p))


def drop_near_end(geom: C, least: float = 0.1) -> Column:
    """The vertices without inner ones nearer than ``least`` to the last."""
    g = col(geom)
    last = F.element_at(g, -1)
    return F.filter(g, lambda p, k: (k == 0) | (k == F.size(g) - 1) | (distance(p["x"], p["y"], last["x"], last["y"]) >= least))


def same_point(ax: C, ay: C, bx: C, by: C, tolerance: float = 1e-5) -> Column:
    return distance(ax, ay, bx, by) <= tolerance


def middle_point(geom: C) -> Column:
    """The middle of the middle segment: of n segments the one numbered floor(n / 2) from 0."""
    g = col(geom)
    k = F.floor((F.size(g) - 1) / 2).cast("int")
    a, b = F.element_at(g, k + 1), F.element_at(g, k + 2)
    return F.struct(along(a["x"], b["x"], F.lit(0.5)).alias("x"), along(a["y"], b["y"], F.lit(0.5)).alias("y"), along(a["z"], b["z"], F.lit(0.5)).alias("z"))
