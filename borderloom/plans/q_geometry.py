"""Queries of geometry, linear referencing, cutting and deforming."""

from __future__ import annotations

from pyspark.sql import functions as F

from borderloom.functions import geometry as g
from borderloom.operators import lines as L
from borderloom.plans.registry import query, rounded
from borderloom.sources import network as net


def _segs(spark, d):
    return L.segments(net.lines(spark, d), "line_id")


def _probes(spark, d, shares):
    total = L.lengths(_segs(spark, d))
    return total.select("id", F.explode(F.array(*map(F.lit, shares))).alias("probe"), "length").select("id", "probe", (F.col("probe") * F.col("length")).alias("s"))


@query("g1_lengths_distances", """, nx AS (SELECT a.*, b.x0 AS u0, b.y0 AS v0, b.x1 AS u1, b.y1 AS v1 FROM edges a JOIN edges b ON b.k = a.k + 14)
 SELECT objectid, round(len, 6) + 0.0 AS len, round(sqrt(pow(u0 - x0, 2) + pow(v0 - y0, 2)), 6) + 0.0 AS apart,
 round(sqrt(pow(u0 - (x0 + (x1 - x0) * t), 2) + pow(v0 - (y0 + (y1 - y0) * t), 2)), 6) + 0.0 AS to_line FROM (SELECT *, least(1, greatest(0, ((u0 - x0) * (x1 - x0) + (v0 - y0) * (y1 - y0)) / (len * len))) AS t FROM nx)""")
def g1(spark, d):
    e = net.edges(spark, d)
    b = e.select((F.col("k") - 14).alias("k"), F.col("x0").alias("u0"), F.col("y0").alias("v0"))
    return rounded(e.join(b, "k").select("objectid", g.distance("x0", "y0", "x1", "y1").alias("len"), g.distance("x0", "y0", "u0", "v0").alias("apart"), g.point_segment("u0", "v0", "x0", "y0", "x1", "y1").alias("to_line")), "len", "apart", "to_line")


@query("g2_g7_abscissae", "SELECT id, pos, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(s, 6) + 0.0 AS s FROM verts")
def g2(spark, d):
    return rounded(L.vertices(_segs(spark, d)).select("id", F.col("pos").cast("long").alias("pos"), "x", "y", "s"), "x", "y", "s")


@query("g7_lengths", "SELECT id, n AS n_segments, round(total, 6) + 0.0 AS length FROM segs WHERE pos = 0")
def g7(spark, d):
    return rounded(L.lengths(_segs(spark, d)), "length")


_SHARES = "(VALUES (-0.1), (0.0), (0.25), (0.5), (1.0), (1.2)) AS q(probe)"


@query("g3_g4_locate", f""", q AS (SELECT CAST(probe AS DOUBLE) AS probe FROM {_SHARES}), asked AS (SELECT id, probe, total, probe * total AS s FROM segs, q WHERE pos = 0),
 hit AS (SELECT a.id, a.probe, a.s, g.pos, g.x0, g.y0, g.x1, g.y1, g.len, g.s0 FROM asked a JOIN segs g USING (id)
  QUALIFY row_number() OVER (PARTITION BY a.id, a.probe ORDER BY CASE WHEN g.s0 + g.len >= a.s OR a.s <= 0 THEN g.pos ELSE 999 END, -g.pos) = 1)
 SELECT id, probe, round(x0 + (x1 - x0) * (s - s0) / len, 6) + 0.0 AS x, round(y0 + (y1 - y0) * (s - s0) / len, 6) + 0.0 AS y FROM hit""")
def g3(spark, d):
    return rounded(L.locate(_segs(spark, d), _probes(spark, d, (-0.1, 0.0, 0.25, 0.5, 1.0, 1.2))).select("id", "probe", "x", "y"), "x", "y")


@query("g5_g16_project", """, pts AS (SELECT id, pos AS probe, x + 3 AS px, y + 4 AS py FROM verts),
 d AS (SELECT p.id, p.probe, g.pos, g.s0, g.len, x0, y0, x1, y1, px, py, least(1, greatest(0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t FROM pts p JOIN segs g USING (id)),
 r AS (SELECT *, sqrt(pow(px - (x0 + (x1 - x0) * t), 2) + pow(py - (y0 + (y1 - y0) * t), 2)) AS dist FROM d QUALIFY row_number() OVER (PARTITION BY id, probe ORDER BY dist, pos) = 1)
 SELECT id, probe, round(s0 + t * len, 6) + 0.0 AS s, round(dist, 6) + 0.0 AS dist FROM r""")
def g5(spark, d):
    s = _segs(spark, d)
    pts = L.vertices(s).select("id", F.col("pos").cast("long").alias("probe"), (F.col("x") + 3).alias("px"), (F.col("y") + 4).alias("py"))
    return rounded(L.project(s, pts).select("id", "probe", "s", "dist"), "s", "dist")


@query("g6_sub_lines", """, lim AS (SELECT DISTINCT id, total, 0.8 * total AS a, 0.3 * total AS b FROM segs),
 ends AS (SELECT l.id, e.s, g.x0 + (g.x1 - g.x0) * (e.s - g.s0) / g.len AS x, g.y0 + (g.y1 - g.y0) * (e.s - g.s0) / g.len AS y FROM lim l, LATERAL (SELECT unnest([l.a, l.b]) AS s) e JOIN segs g ON g.id = l.id AND g.s0 < e.s AND e.s <= g.s0 + g.len),
 every AS (SELECT * FROM ends UNION ALL SELECT v.id, v.s, v.x, v.y FROM verts v JOIN lim l USING (id) WHERE v.s > l.b AND v.s < l.a)
 SELECT id, row_number() OVER (PARTITION BY id ORDER BY s DESC) - 1 AS k, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM every""")
def g6(spark, d):
    s = _segs(spark, d)
    ranges = L.lengths(s).select("id", F.lit(0).alias("probe"), (0.8 * F.col("length")).alias("s_from"), (0.3 * F.col("length")).alias("s_to"))
    return rounded(L.sub_lines(s, ranges).select("id", F.col("k").cast("long").alias("k"), "x", "y"), "x", "y")


_CUTS = """, cuts AS (SELECT id, s0 + len * y0 / (y0 - y1) AS s FROM segs WHERE y0 <> y1 AND y0 / (y0 - y1) BETWEEN 0 AND 1),
 inner_cuts AS (SELECT c.id, c.s FROM cuts c JOIN (SELECT DISTINCT id, total FROM segs) l USING (id) WHERE c.s > 1e-5 AND c.s < total - 1e-5),
 apart AS (SELECT id, s, s - lag(s) OVER (PARTITION BY id ORDER BY s) AS gap FROM inner_cuts QUALIFY gap IS NULL OR gap > 1e-5),
 marks AS (SELECT id, s FROM apart UNION ALL SELECT DISTINCT id, 0.0 FROM segs UNION ALL SELECT DISTINCT id, total FROM segs),
 pieces AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY s) - 1 AS piece, s AS s_from, lead(s) OVER (PARTITION BY id ORDER BY s) AS s_to FROM marks QUALIFY s_to IS NOT NULL)"""


def _pieces(spark, d):
    s = _segs(spark, d)
    cutter = L.lengths(s).join(L.vertices(s).groupBy("id").agg(F.min("x").alias("a"), F.max("x").alias("b")), "id")
    return s, L.pieces(s, L.cuts_by_segments(s, cutter.select("id", (F.col("a") - 1).alias("u0"), F.lit(0.0).alias("v0"), (F.col("b") + 1).alias("u1"), F.lit(0.0).alias("v1"))))


@query("g8_g9_pieces", _CUTS + " SELECT id, piece, round(s_from, 6) + 0.0 AS s_from, round(s_to, 6) + 0.0 AS s_to FROM pieces")
def g8(spark, d):
    return rounded(_pieces(spark, d)[1].select("id", F.col("piece").cast("long").alias("piece"), "s_from", "s_to"), "s_from", "s_to")


@query("g10_trim_start", _CUTS + ", f AS (SELECT *, count(*) OVER (PARTITION BY id) = 1 OR piece > 0 AS kept FROM pieces) SELECT id, kept, round(min(s_from), 6) + 0.0 AS s_from, round(max(s_to), 6) + 0.0 AS s_to FROM f GROUP BY id, kept")
def g10(spark, d):
    return rounded(L.trim(_pieces(spark, d)[1], True), "s_from", "s_to")


@query("g11_truncate_ends", _CUTS + """, l AS (SELECT DISTINCT id, total FROM segs) SELECT l.id, round(coalesce(min(s) FILTER (s <= total / 2), 0), 6) + 0.0 AS s_from, round(coalesce(max(s) FILTER (s >= total / 2), total), 6) + 0.0 AS s_to
 FROM l LEFT JOIN apart USING (id) GROUP BY l.id, total""")
def g11(spark, d):
    s, parts = _pieces(spark, d)
    return rounded(L.truncate_ends(parts, L.lengths(s).select("id", "length")), "s_from", "s_to")


@query("g15_angles", """SELECT a.objectid, round(acos(least(1, greatest(-1, ((a.x1 - a.x0) * (b.x1 - b.x0) + (a.y1 - a.y0) * (b.y1 - b.y0)) / (a.len * b.len)))), 5) + 0.0 AS angle FROM edges a JOIN edges b ON b.k = a.k + 2""")
def g15(spark, d):
    e = net.edges(spark, d).withColumns({"dx": F.expr("x1 - x0"), "dy": F.expr("y1 - y0")})
    b = e.select((F.col("k") - 2).alias("k"), F.col("dx").alias("ex"), F.col("dy").alias("ey"))
    return rounded(e.join(b, "k").select("objectid", g.angle("dx", "dy", "ex", "ey").alias("angle")), "angle", digits=5)


@query("g17_centroids", "SELECT i, p, round(avg(x0), 6) + 0.0 AS x, round(avg(y0), 6) + 0.0 AS y FROM edges GROUP BY i, p")
def g17(spark, d):
    return rounded(net.edges(spark, d).groupBy(F.expr("m div 7").alias("i"), "p").agg(F.avg("x0").alias("x"), F.avg("y0").alias("y")), "x", "y")


@query("g13_segment_distance", """, ab AS (SELECT a.objectid, a.x0 AS ax, a.y0 AS ay, a.x1 AS bx, a.y1 AS by_, b.x0 AS cx, b.y0 AS cy, b.x1 AS dx, b.y1 AS dy FROM edges a JOIN edges b ON b.k = a.k + 1 AND a.p = 0),
 t AS (SELECT *, (bx - ax) * (dy - cy) - (by_ - ay) * (dx - cx) AS den FROM ab),
 m AS (SELECT *, CASE WHEN den <> 0 THEN ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / den END AS t, CASE WHEN den <> 0 THEN ((cx - ax) * (by_ - ay) - (cy - ay) * (bx - ax)) / den END AS u FROM t),
 pd AS (SELECT objectid, t, u, unnest([{'px': ax, 'py': ay, 'qx': cx, 'qy': cy, 'rx': dx, 'ry': dy}, {'px': bx, 'py': by_, 'qx': cx, 'qy': cy, 'rx': dx, 'ry': dy}, {'px': cx, 'py': cy, 'qx': ax, 'qy': ay, 'rx': bx, 'ry': by_}, {'px': dx, 'py': dy, 'qx': ax, 'qy': ay, 'rx': bx, 'ry': by_}]) AS q FROM m),
 f AS (SELECT objectid, t, u, q, least(1, greatest(0, ((q.px - q.qx) * (q.rx - q.qx) + (q.py - q.qy) * (q.ry - q.qy)) / (pow(q.rx - q.qx, 2) + pow(q.ry - q.qy, 2)))) AS s FROM pd)
 SELECT objectid, round(CASE WHEN coalesce(t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1, FALSE) THEN 0 ELSE min(sqrt(pow(q.px - (q.qx + (q.rx - q.qx) * s), 2) + pow(q.py - (q.qy + (q.ry - q.qy) * s), 2))) END, 6) + 0.0 AS dist FROM f GROUP BY objectid, t, u""")
def g13(spark, d):
    e = net.edges(spark, d)
    b = e.select((F.col("k") - 1).alias("k"), F.col("x0").alias("u0"), F.col("y0").alias("v0"), F.col("x1").alias("u1"), F.col("y1").alias("v1"))
    return rounded(e.where("p = 0").join(b, "k").select("objectid", g.segment_segment("x0", "y0", "x1", "y1", "u0", "v0", "u1", "v1").alias("dist")), "dist")


_PAIR_SEGS = ", be AS (SELECT *, id // 2 AS i FROM segs WHERE id % 2 = 0), fr AS (SELECT *, id // 2 AS i FROM segs WHERE id % 2 = 1), bv AS (SELECT *, id // 2 AS i FROM verts WHERE id % 2 = 0), fv AS (SELECT *, id // 2 AS i FROM verts WHERE id % 2 = 1)"


def _pair_segs(spark, d):
    s = _segs(spark, d)
    return s.where("id % 2 = 0").withColumn("id", F.expr("id div 2")), s.where("id % 2 = 1").withColumn("id", F.expr("id div 2"))


def _way(v, s):
    t = "least(1, greatest(0, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))))"
    return f"SELECT i, max(d) AS d FROM (SELECT v.i, v.pos, min(sqrt(pow(x - (x0 + (x1 - x0) * {t}), 2) + pow(y - (y0 + (y1 - y0) * {t}), 2))) AS d FROM {v} v JOIN {s} s ON v.i = s.i GROUP BY v.i, v.pos) GROUP BY i"


@query("g18_hausdorff", _PAIR_SEGS + f" SELECT i AS id, round(max(d), 6) + 0.0 AS hausdorff FROM ({_way('bv', 'fr')} UNION ALL {_way('fv', 'be')}) GROUP BY i HAVING count(*) = 2")
def g18(spark, d):
    return rounded(L.hausdorff(*_pair_segs(spark, d)), "hausdorff")


@query("g19_g26_area_mean_width", "SELECT poly_id, round((xb - xa) * (yb - ya), 4) + 0.0 AS area, round((xb - xa) * (yb - ya) / (xb - xa + yb - ya), 4) + 0.0 AS mean_width FROM rects")
def g19(spark, d):
    return rounded(net.water(spark, d).select("poly_id", g.ring_area("ring").alias("area"), g.mean_width("ring").alias("mean_width")), "area", "mean_width", digits=4)


@query("g21_g22_mean_line", _PAIR_SEGS + """, rel AS (SELECT DISTINCT i, round(s / total, 9) AS rel FROM (SELECT i, s, total FROM bv UNION ALL SELECT i, s, total FROM fv) WHERE i IN (SELECT i FROM be) AND i IN (SELECT i FROM fr)),
 pa AS (SELECT r.i, r.rel, x0 + (x1 - x0) * (r.rel * total - s0) / len AS x, y0 + (y1 - y0) * (r.rel * total - s0) / len AS y FROM rel r JOIN be b ON r.i = b.i QUALIFY row_number() OVER (PARTITION BY r.i, r.rel ORDER BY CASE WHEN s0 + len >= r.rel * total OR r.rel <= 0 THEN pos ELSE 99 END, -pos) = 1),
 pb AS (SELECT r.i, r.rel, x0 + (x1 - x0) * (r.rel * total - s0) / len AS x, y0 + (y1 - y0) * (r.rel * total - s0) / len AS y FROM rel r JOIN fr b ON r.i = b.i QUALIFY row_number() OVER (PARTITION BY r.i, r.rel ORDER BY CASE WHEN s0 + len >= r.rel * total OR r.rel <= 0 THEN pos ELSE 99 END, -pos) = 1)
 SELECT pa.i AS id, pa.rel, round((pa.x + pb.x) / 2, 4) + 0.0 AS x, round((pa.y + pb.y) / 2, 4) + 0.0 AS y FROM pa JOIN pb USING (i, rel)""")
def g21(spark, d):
    return rounded(L.mean_line(*_pair_segs(spark, d)).select("id", "rel", "x", "y"), "x", "y", digits=4)


@query("g23_deform", """, mv AS (SELECT DISTINCT id, total, 0.0 AS dx0, 2.0 AS dy0, 1.5 AS dx1, -2.0 AS dy1, least(10.0, total, 30.0) AS r0, least(12.5, total, 30.0) AS r1 FROM segs),
 lim AS (SELECT id, r0 AS s FROM mv UNION ALL SELECT id, total - r1 FROM mv),
 far AS (SELECT l.id, l.s FROM lim l JOIN verts v USING (id) GROUP BY l.id, l.s HAVING min(abs(v.s - l.s)) > 1),
 added AS (SELECT f.id, f.s, x0 + (x1 - x0) * (f.s - s0) / len AS x, y0 + (y1 - y0) * (f.s - s0) / len AS y FROM far f JOIN segs g ON g.id = f.id AND s0 < f.s AND f.s <= s0 + len),
 every AS (SELECT id, s, x, y FROM verts UNION ALL SELECT id, s, x, y FROM added)
 SELECT e.id, round(e.s, 6) + 0.0 AS s, round(CASE WHEN e.s = 0 THEN x + dx0 WHEN e.s = total THEN x + dx1 ELSE x + greatest(0, 1 - e.s / r0) * dx0 + greatest(0, 1 - (total - e.s) / r1) * dx1 END, 6) + 0.0 AS x,
 round(CASE WHEN e.s = 0 THEN y + dy0 WHEN e.s = total THEN y + dy1 ELSE y + greatest(0, 1 - e.s / r0) * dy0 + greatest(0, 1 - (total - e.s) / r1) * dy1 END, 6) + 0.0 AS y FROM every e JOIN mv USING (id)""")
def g23(spark, d):
    s = _segs(spark, d)
    moves = s.select("id").distinct().withColumns({"dx0": F.lit(0.0), "dy0": F.lit(2.0), "dx1": F.lit(1.5), "dy1": F.lit(-2.0)})
    return rounded(L.deform(s, moves).select("id", "s", "x", "y"), "s", "x", "y")


@query("g24_g28_middle_and_edits", """, f AS (SELECT * FROM segs WHERE pos = 2), a AS (SELECT * FROM segs WHERE pos = 0), z AS (SELECT * FROM segs WHERE pos = 4)
 SELECT f.id, round((f.x0 + f.x1) / 2, 6) + 0.0 AS mx, round((f.y0 + f.y1) / 2, 6) + 0.0 AS my, z.x1 + 0.0 AS first_of_reverse, a.x0 + 1.0 AS moved_x, 7.0 AS z0, TRUE AS cleared FROM f JOIN a USING (id) JOIN z USING (id)""")
def g24(spark, d):
    n = net.lines(spark, d)
    n = n.withColumn("mid", g.middle_point("geom")).withColumn("rev", g.reverse("geom"))
    n = n.withColumn("moved", g.set_point("geom", 0, F.get("geom", F.lit(0))["x"] + 1, F.get("geom", F.lit(0))["y"])).withColumn("cleared", g.with_z("geom", None)).withColumn("filled", g.fill_z(g.with_z("geom", None), 7.0))
    return rounded(
        n.select(F.col("line_id").alias("id"), F.col("mid.x").alias("mx"), F.col("mid.y").alias("my"), F.get("rev", F.lit(0))["x"].alias("first_of_reverse"), F.get("moved", F.lit(0))["x"].alias("moved_x"), F.get("filled", F.lit(0))["z"].alias("z0"), F.get("cleared", F.lit(0))["z"].isNull().alias("cleared")),
        "mx", "my",
    )


@query("g32_nearest_vertex", """, pts AS (SELECT id, 0 AS probe, avg(x) AS px, avg(y) AS py FROM verts GROUP BY id)
 SELECT p.id, v.pos FROM pts p JOIN verts v USING (id) QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY sqrt(pow(x - px, 2) + pow(y - py, 2)), v.pos) = 1""")
def g32(spark, d):
    s = _segs(spark, d)
    pts = L.vertices(s).groupBy("id").agg(F.avg("x").alias("px"), F.avg("y").alias("py")).withColumn("probe", F.lit(0))
    return L.nearest_vertex(s, pts).select("id", F.col("pos").cast("long").alias("pos"))


@query("g30_z_from_sources", """, p AS (SELECT id, x0 + (x1 - x0) * 0.5 AS px, y0 + (y1 - y0) * 0.5 AS py, s0 + 0.5 * len AS s FROM segs WHERE pos = 1) SELECT id, round((s * 0.1 + s * 0.3) / 2, 6) + 0.0 AS z FROM p""")
def g30(spark, d):
    s = _segs(spark, d)
    mid = s.where("pos = 1").select("id", F.lit(0).alias("probe"), F.expr("x0 + (x1 - x0) * 0.5").alias("px"), F.expr("y0 + (y1 - y0) * 0.5").alias("py"))
    slope = lambda name, k: s.withColumns({"z0": F.col("s0") * k, "z1": (F.col("s0") + F.col("len")) * k, "src": F.lit(name)})
    return rounded(L.z_from(slope("a", 0.1).union(slope("b", 0.3)), mid).select("id", "z"), "z")
