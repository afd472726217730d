"""Queries of the pipeline's steps and their helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from borderloom.operators import cleaning as C
from borderloom.operators import graph as G
from borderloom.operators import matching as M
from borderloom.plans.params import load
from borderloom.plans.pipeline import State, run
from borderloom.plans.registry import CLIP, query, rounded
from borderloom.sources import network as net

TN, HY = load("tn"), load("hy")
ENDS = ("x0", "y0", "x1", "y1")

_RATIO = CLIP + """, runs AS (SELECT *, max(t1) OVER (PARTITION BY objectid ORDER BY t0, t1, poly_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM clip WHERE t0 < t1),
 inside AS (SELECT objectid, sum(greatest(0, t1 - greatest(t0, coalesce(reach, 0)))) AS share FROM runs GROUP BY objectid),
 ratios AS (SELECT objectid, round(coalesce(share, 0), 9) AS ratio FROM edges LEFT JOIN inside USING (objectid))"""


@query("step201_fill_fictitious", _RATIO + """ SELECT objectid, CASE WHEN ratio >= 0.5 THEN 'true' ELSE 'false' END AS fictitious,
 CASE WHEN ratio >= 0.5 AND fictitious = 'false' THEN 'debug_201_to_true' WHEN ratio < 0.5 AND fictitious = 'true' THEN 'debug_201_to_false' END AS w_tag FROM edges JOIN ratios USING (objectid)""")
def step201(spark, d):
    return M.fill_fictitious(net.edges(spark, d), net.water(spark, d), HY).select("objectid", "fictitious", "w_tag")


_JUNCTIONS = """, half AS (SELECT p, x0 AS x, y0 AS y, fictitious FROM edges UNION ALL SELECT p, x1, y1, fictitious FROM edges),
 jn AS (SELECT p, x, y, count(*) AS degree, bool_or(fictitious = 'true') AS f FROM half GROUP BY p, x, y HAVING count(*) >= 3),
 key AS (SELECT *, CAST(floor(x / 1e-5 + 0.5) AS BIGINT) || ':' || CAST(floor(y / 1e-5 + 0.5) AS BIGINT) AS id FROM jn),
 pr AS (SELECT a.id AS a_id, b.id AS b_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, a.f AS fa, b.f AS fb, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS dist FROM key a JOIN key b ON a.p = 0 AND b.p = 1 AND a.degree = b.degree AND b.x BETWEEN a.x - 10 AND a.x + 10 WHERE dist < 10),
 best AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY round(dist, 9), b_id) = 1 AND row_number() OVER (PARTITION BY b_id ORDER BY round(dist, 9), a_id) = 1),
 target AS (SELECT ax, ay, bx, by_, CASE WHEN fa AND NOT fb THEN ax WHEN fb AND NOT fa THEN bx ELSE (ax + bx) / 2 END AS x, CASE WHEN fa AND NOT fb THEN ay WHEN fb AND NOT fa THEN by_ ELSE (ay + by_) / 2 END AS y FROM best)"""


@query("step202_match_junctions", _JUNCTIONS + " SELECT round(ax, 6) + 0.0 AS ax, round(ay, 6) + 0.0 AS ay, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM target")
def step202(spark, d):
    e = net.edges(spark, d)
    m = M.match_junctions(e, HY).join(M.junctions(e, "be").select(F.col("id").alias("a_id"), F.col("x").alias("ax"), F.col("y").alias("ay")), "a_id")
    return rounded(m.select("ax", "ay", "x", "y"), "ax", "ay", "x", "y")


@query("step202_move_junctions", _JUNCTIONS + """, mv AS (SELECT 0 AS p, ax AS ox, ay AS oy, x, y FROM target UNION ALL SELECT 1, bx, by_, x, y FROM target)
 SELECT objectid, round(coalesce(s.x, x0), 6) + 0.0 AS x0, round(coalesce(s.y, y0), 6) + 0.0 AS y0, round(coalesce(e.x, x1), 6) + 0.0 AS x1, round(coalesce(e.y, y1), 6) + 0.0 AS y1
 FROM edges LEFT JOIN mv s ON s.p = edges.p AND s.ox = x0 AND s.oy = y0 LEFT JOIN mv e ON e.p = edges.p AND e.ox = x1 AND e.oy = y1""")
def step202_move(spark, d):
    e = net.edges(spark, d)
    return rounded(M.move_junctions(e, M.match_junctions(e, HY), HY).select("objectid", *ENDS), *ENDS)


@query("step204_lines_in_areas")
def step204(spark, d):
    out = M.cut(C.lines_in_areas(net.edges(spark, d), HY))
    return out.select("objectid", "country", "w_tag", "kind", F.size("geom").alias("n"))


@query("step204_merge_tagged")
def step204_merge(spark, d):
    return C.merge_tagged_lines(M.cut(C.lines_in_areas(net.edges(spark, d), HY)))


# The band round a border piece is a rectangle; a piece's share of an edge is an interval of its parameter.
_BAND = CLIP.replace("rects w", "bands w").replace(", clip AS", ", bands AS (SELECT 'B' || i AS poly_id, i, 175 * i - 10.0 AS xa, -20.0 AS ya, 175 * i + 165.0 AS xb, 20.0 AS yb FROM chunks), clip AS", 1) + """,
 iv AS (SELECT * FROM clip WHERE t0 < t1), rn AS (SELECT *, (t0 - max(t1) OVER (PARTITION BY objectid ORDER BY t0, t1, poly_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) * len AS gap FROM iv),
 fr AS (SELECT *, sum(CASE WHEN gap > 0.1 THEN 1 ELSE 0 END) OVER (PARTITION BY objectid ORDER BY t0, t1, poly_id) AS run FROM rn),
 ag AS (SELECT objectid, min(t0) AS lo, max(t1) AS hi, sum(t1 - t0) AS inside FROM fr WHERE run = 0 GROUP BY objectid),
 f1 AS (SELECT objectid, t0, t1 FROM fr QUALIFY row_number() OVER (PARTITION BY objectid ORDER BY t0, t1, poly_id) = 1)
 SELECT objectid AS linked_feat_id, country, round(x0 + (x1 - x0) * t0, 6) + 0.0 AS x0, round(x0 + (x1 - x0) * t1, 6) + 0.0 AS x1 FROM edges JOIN ag USING (objectid) JOIN f1 USING (objectid)
 WHERE CASE WHEN lo <= 0 AND hi >= 1 THEN abs(y1 - y0) / len < sin(radians(25.0)) ELSE inside > 0.6 * (hi - lo) END AND x0 <> x1"""


@query("step210_lines_by_country", _BAND)
def step210(spark, d):
    return rounded(M.lines_by_country(net.edges(spark, d), net.boundary(spark, d), TN).select("linked_feat_id", "country", "x0", "x1"), "x0", "x1")


@query("step211_merge_lines")
def step211(spark, d):
    e = net.edges(spark, d)
    return rounded(M.merge_lines(M.lines_by_country(e, net.boundary(spark, d), TN), e, TN), *ENDS)


_SNAPPED = """, ends AS (SELECT m AS k, x0 AS x, y0 AS y FROM c UNION ALL SELECT m, x1, y1 FROM c), vx AS (SELECT x, y, count(*) AS n, list(k) AS ks FROM ends GROUP BY x, y),
 key AS (SELECT *, CAST(floor(x / 0.01 + 0.5) AS BIGINT) || ':' || CAST(floor(y / 0.01 + 0.5) AS BIGINT) AS id FROM vx),
 one AS (SELECT a.id AS a, b.id AS b, a.x, a.y, b.x AS bx, b.y AS by_, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM key a JOIN key b ON a.n = 1 AND b.x BETWEEN a.x - 3 AND a.x + 3 AND a.id <> b.id AND NOT list_has_any(a.ks, b.ks) WHERE d > 0 AND d <= 2),
 pr AS (SELECT * FROM one UNION SELECT b, a, bx, by_, x, y, d FROM one),
 bst AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(d, 9), b) = 1 AND row_number() OVER (PARTITION BY b ORDER BY round(d, 9), a) = 1)"""


@query("step212_snap_lines", ", c AS (SELECT m, x0 + CASE WHEN m % 2 = 0 THEN 0.7 ELSE 0 END AS x0, y0, x1, y1 FROM cls)" + _SNAPPED + """ SELECT 'CONNECTINGLINE' || m AS objectid, round(coalesce((s.x + s.bx) / 2, x0), 6) + 0.0 AS x0, round(coalesce((s.y + s.by_) / 2, y0), 6) + 0.0 AS y0,
 round(coalesce((e.x + e.bx) / 2, x1), 6) + 0.0 AS x1, round(coalesce((e.y + e.by_) / 2, y1), 6) + 0.0 AS y1 FROM c LEFT JOIN bst s ON s.x = x0 AND s.y = y0 LEFT JOIN bst e ON e.x = x1 AND e.y = y1""")
def step212(spark, d):
    c = net.connecting_lines(spark, d).withColumn("x0", F.expr("x0 + case when m % 2 = 0 then 0.7D else 0D end"))
    return rounded(M.snap_lines(c, TN).select("objectid", *ENDS), *ENDS)


@query("step213_delete_lines")
def step213(spark, d):
    e = net.edges(spark, d)
    return M.delete_lines(net.connecting_lines(spark, d), e, TN).select("objectid")


_SIDE = "least(1, greatest(0, ((c.{x} - {s}.x0) * ({s}.x1 - {s}.x0) + (c.{y} - {s}.y0) * ({s}.y1 - {s}.y0)) / ({s}.len * {s}.len)))"
_T = {(s, e): _SIDE.format(s=s, x=f"x{e}", y=f"y{e}") for s in "ab" for e in "01"}


def _new(axis, e):
    a = f"(a.{axis}0 + (a.{axis}1 - a.{axis}0) * ta{e})"
    b = f"(b.{axis}0 + (b.{axis}1 - b.{axis}0) * tb{e})"
    return f"round(CASE WHEN a.fictitious = 'true' AND b.fictitious = 'false' THEN {a} WHEN b.fictitious = 'true' AND a.fictitious = 'false' THEN {b} ELSE ({a} + {b}) / 2 END, 6) + 0.0 AS {axis}{e}"


@query("step214_update_lines", f""" SELECT c.objectid, {_new('x', 0)}, {_new('y', 0)}, {_new('x', 1)}, {_new('y', 1)} FROM cls c JOIN edges a ON a.m = c.m AND a.p = 0 JOIN edges b ON b.m = c.m AND b.p = 1,
 LATERAL (SELECT {_T['a', '0']} AS ta0, {_T['a', '1']} AS ta1, {_T['b', '0']} AS tb0, {_T['b', '1']} AS tb1) WHERE abs(ta0 - ta1) > 1e-9 AND abs(tb0 - tb1) > 1e-9""")
def step214(spark, d):
    return rounded(M.update_lines(net.connecting_lines(spark, d), net.edges(spark, d), TN).select("objectid", *ENDS), *ENDS)


@query("step214_continue_lines")
def step214_continue(spark, d):
    e, c = net.edges(spark, d), net.connecting_lines(spark, d)
    return rounded(M.continue_lines(c, M.update_lines(c, e, TN), e).select("objectid", *ENDS), *ENDS)


@query("step220_connect_lines", f""", pc AS (SELECT c.objectid, e.objectid AS edge, e.len, c.x0 AS cx0, c.y0 AS cy0, c.x1 AS cx1, c.y1 AS cy1, e.x0, e.y0, e.x1, e.y1 FROM cls c JOIN edges e ON e.m = c.m),
 ds AS (SELECT *, least(sqrt(pow(cx0 - x0, 2) + pow(cy0 - y0, 2)), sqrt(pow(cx1 - x1, 2) + pow(cy1 - y1, 2))) <= least(sqrt(pow(cx0 - x1, 2) + pow(cy0 - y1, 2)), sqrt(pow(cx1 - x0, 2) + pow(cy1 - y0, 2))) AS straight FROM pc),
 pp AS (SELECT *, CASE WHEN straight THEN cx0 ELSE cx1 END AS px0, CASE WHEN straight THEN cy0 ELSE cy1 END AS py0, CASE WHEN straight THEN cx1 ELSE cx0 END AS px1, CASE WHEN straight THEN cy1 ELSE cy0 END AS py1 FROM ds),
 tt AS (SELECT *, least(1, greatest(0, ((px0 - x0) * (x1 - x0) + (py0 - y0) * (y1 - y0)) / (len * len))) AS r0, least(1, greatest(0, ((px1 - x0) * (x1 - x0) + (py1 - y0) * (y1 - y0)) / (len * len))) AS r1 FROM pp)
 SELECT objectid, edge, round(CASE WHEN r0 * len < 1 THEN 0 WHEN (1 - r0) * len < 1 THEN len ELSE r0 * len END, 6) + 0.0 AS s_from, round(CASE WHEN r1 * len < 1 THEN 0 WHEN (1 - r1) * len < 1 THEN len ELSE r1 * len END, 6) + 0.0 AS s_to FROM tt""")
def step220(spark, d):
    return rounded(M.connect_lines(net.edges(spark, d), net.connecting_lines(spark, d), TN).select("objectid", "edge", "s_from", "s_to"), "s_from", "s_to")


# two lines an edge, the first and the last third of the one there is
_THIRDS = "SELECT objectid || CASE WHEN f = 0 THEN 'a' ELSE 'b' END AS objectid, country, linked_feat_id, m, x0 + (x1 - x0) * f / 3 AS x0, y0 + (y1 - y0) * f / 3 AS y0, x0 + (x1 - x0) * (f + 1) / 3 AS x1, y0 + (y1 - y0) * (f + 1) / 3 AS y1"


@query("step220_cut_edges", f""", two AS ({_THIRDS} FROM cls, (VALUES (0), (2)) AS v(f)), pc AS (SELECT e.objectid, e.len, c.x0 AS cx0, c.y0 AS cy0, c.x1 AS cx1, c.y1 AS cy1, e.x0, e.y0, e.x1, e.y1 FROM two c JOIN edges e ON e.m = c.m),
 tt AS (SELECT *, least(1, greatest(0, ((cx0 - x0) * (x1 - x0) + (cy0 - y0) * (y1 - y0)) / (len * len))) AS r0, least(1, greatest(0, ((cx1 - x0) * (x1 - x0) + (cy1 - y0) * (y1 - y0)) / (len * len))) AS r1 FROM pc),
 sn AS (SELECT *, CASE WHEN r0 * len < 1 THEN 0 WHEN (1 - r0) * len < 1 THEN 1 ELSE r0 END * len AS s0, CASE WHEN r1 * len < 1 THEN 0 WHEN (1 - r1) * len < 1 THEN 1 ELSE r1 END * len AS s1 FROM tt),
 mk AS (SELECT objectid, least(s0, s1) AS lo, greatest(s0, s1) AS hi FROM sn UNION ALL SELECT DISTINCT objectid, len, len FROM sn),
 gp AS (SELECT objectid, coalesce(max(hi) OVER (PARTITION BY objectid ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, lo AS b FROM mk),
 nb AS (SELECT *, row_number() OVER (PARTITION BY objectid ORDER BY a) AS nth FROM gp WHERE b - a > 1e-5)
 SELECT objectid || '/' || nth AS objectid, round(x0 + (x1 - x0) * a / len, 6) + 0.0 AS x0, round(y0 + (y1 - y0) * a / len, 6) + 0.0 AS y0, round(x0 + (x1 - x0) * b / len, 6) + 0.0 AS x1, round(y0 + (y1 - y0) * b / len, 6) + 0.0 AS y1 FROM nb JOIN edges e USING (objectid)
 UNION ALL SELECT objectid, round(x0, 6) + 0.0, round(y0, 6) + 0.0, round(x1, 6) + 0.0, round(y1, 6) + 0.0 FROM edges WHERE objectid NOT IN (SELECT objectid FROM sn)""")
def step220_cut(spark, d):
    c = net.connecting_lines(spark, d)
    third = lambda f: c.withColumns({k: F.expr(f"{k[0]}0 + ({k[0]}1 - {k[0]}0) * {f + int(k[1])} / 3") for k in ENDS}).withColumn("objectid", F.concat("objectid", F.lit("a" if f == 0 else "b")))
    e = net.edges(spark, d)
    return rounded(M.without_parts(e, M.connect_lines(e, third(0).union(third(2)), TN)).select("objectid", *ENDS), *ENDS)


# crossings of edges with the border, each moved to the nearest crossing of the edge with a connecting line
_CROSS = """, at0 AS (SELECT objectid AS edge, country, form_of_way AS way, m, x0, y0, x1, y1, round(y0 / (y0 - y1), 9) AS t, x0 + (x1 - x0) * (y0 / (y0 - y1)) AS x, 0.0 AS y FROM edges WHERE y0 <> y1 AND y0 / (y0 - y1) BETWEEN 0 AND 1),
 ec AS (SELECT e.objectid AS edge, c.objectid AS cl, e.x0, e.y0, e.x1, e.y1, c.x0 AS u0, c.y0 AS v0, c.x1 AS u1, c.y1 AS v1 FROM edges e JOIN cls c ON c.m BETWEEN e.m - 8 AND e.m + 8),
 et AS (SELECT *, (x1 - x0) * (v1 - v0) - (y1 - y0) * (u1 - u0) AS den FROM ec), eu AS (SELECT *, ((u0 - x0) * (v1 - v0) - (v0 - y0) * (u1 - u0)) / den AS t, ((x0 - u0) * (y1 - y0) - (y0 - v0) * (x1 - x0)) / ((u1 - u0) * (y1 - y0) - (v1 - v0) * (x1 - x0)) AS u FROM et WHERE den <> 0),
 cx AS (SELECT edge, cl, x0 + (x1 - x0) * t AS cx, y0 + (y1 - y0) * t AS cy FROM eu WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1),
 nr AS (SELECT a.edge, a.t, cx, cy FROM at0 a JOIN cx USING (edge) WHERE sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)) <= 5 QUALIFY row_number() OVER (PARTITION BY a.edge, a.t ORDER BY round(sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)), 9), cl, cx, cy) = 1),
 xp AS (SELECT 'X' || edge AS id, edge, country, way, coalesce(cx, x) AS x, coalesce(cy, y) AS y FROM at0 LEFT JOIN nr USING (edge, t))"""


@query("step240_crossing_points", _CROSS + " SELECT id, edge, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM xp")
def step240_crossings(spark, d):
    return rounded(M.crossing_points(net.edges(spark, d), net.boundary(spark, d), net.connecting_lines(spark, d), TN).select("id", "edge", "x", "y"), "x", "y")


_LOOSE = """, half AS (SELECT k, p, x0 AS x, y0 AS y, x1 AS xw, y1 AS yw, len FROM edges UNION ALL SELECT k, p, x1, y1, x0, y0, len FROM edges), deg AS (SELECT x, y FROM half GROUP BY x, y HAVING count(*) = 1),
 tip AS (SELECT h.*, CASE WHEN (y - yw) * y < 0 THEN -y / ((y - yw) / len) END AS ad, abs(y) AS od FROM half h JOIN deg USING (x, y) WHERE h.y * h.yw > 0)"""


@query("step240_undershoots", _LOOSE + " SELECT CAST(k AS VARCHAR) AS edge, round(CASE WHEN ad IS NULL OR ad > 25 OR od < ad / 3 THEN x ELSE x + ad * (x - xw) / len END, 6) + 0.0 AS x, 0.0 AS y FROM tip WHERE (ad <= 25 OR od < 25) AND x BETWEEN -10 AND (SELECT max(i) * 175 + 165 FROM edges)")
def step240_undershoots(spark, d):
    return rounded(M.undershoots(net.edges(spark, d), net.boundary(spark, d), TN).select("edge", "x", "y"), "x", "y")


_UNDER = """SELECT k, CAST(k AS VARCHAR) AS edge, x AS tx, y AS ty, CASE WHEN ad IS NULL OR ad > 25 OR od < ad / 3 THEN x ELSE x + ad * (x - xw) / len END AS ux FROM tip WHERE (ad <= 25 OR od < 25) AND x BETWEEN -10 AND (SELECT max(i) * 175 + 165 FROM edges)"""
_POINTS = _CROSS + _LOOSE + f""", un AS ({_UNDER}),
 pts AS (SELECT * FROM xp UNION ALL SELECT 'U' || un.edge || '@' || CAST(floor(tx / 1e-5 + 0.5) AS BIGINT) || ':' || CAST(floor(ty / 1e-5 + 0.5) AS BIGINT), un.edge, e.country, e.form_of_way, ux, 0.0 FROM un JOIN edges e ON e.k = un.k),
 pr AS (SELECT a.id AS a_id, b.id AS b_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist, CASE WHEN a.way <> 'road' AND b.way <> 'road' THEN 12 ELSE 5 END AS most FROM pts a JOIN pts b ON a.country = 'be' AND b.country = 'fr' AND b.x BETWEEN a.x - 12 AND a.x + 12 WHERE dist < most),
 mu AS (SELECT a_id, b_id FROM pr QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY round(dist, 9), b_id) = 1 AND row_number() OVER (PARTITION BY b_id ORDER BY round(dist, 9), a_id) = 1),
 began AS (SELECT a_id AS id, a_id AS grp FROM mu UNION ALL SELECT b_id, a_id FROM mu), sides AS (SELECT a_id AS id, b_id AS other, dist FROM pr UNION ALL SELECT b_id, a_id, dist FROM pr),
 rest AS (SELECT * FROM (SELECT id, other FROM sides QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(dist, 9), other) = 1) WHERE id NOT IN (SELECT id FROM began)),
 joins AS (SELECT r.id, r.other, coalesce(b.grp, r.other) AS grp, b.grp IS NULL AS fresh FROM rest r LEFT JOIN began b ON b.id = r.other),
 mem AS (SELECT id, min(grp) AS grp FROM (SELECT * FROM began UNION ALL SELECT id, grp FROM joins UNION ALL SELECT other, other FROM joins WHERE fresh) GROUP BY id)"""


def _points(spark, d):
    e, b = net.edges(spark, d), net.boundary(spark, d)
    return M.cut(M.crossing_points(e, b, net.connecting_lines(spark, d), TN)).union(M.cut(M.undershoots(e, b, TN)))


@query("step240_pair_points", _POINTS + " SELECT grp AS \"group\", id FROM mem")
def step240_pairs(spark, d):
    return M.pair_points(_points(spark, d), TN).select("group", "id")


@query("step240_connecting_points", _POINTS + " SELECT 'CONNECTINGPOINT' || grp AS objectid, count(*) AS n, round(avg(x), 6) + 0.0 AS x, 0.0 AS y FROM mem JOIN pts USING (id) GROUP BY grp")
def step240(spark, d):
    return rounded(M.connecting_points(M.pair_points(_points(spark, d), TN), net.boundary(spark, d)).select("objectid", "n", "x", "y"), "x", "y")


@query("step240_snap_points_to_lines")
def step240_snap(spark, d):
    cps = M.connecting_points(M.pair_points(_points(spark, d), TN), net.boundary(spark, d))
    return rounded(M.snap_points_to_lines(cps, net.connecting_lines(spark, d), TN), "t", "x", "y")


@query("step250_connect_points", _POINTS + """, cp AS (SELECT 'CONNECTINGPOINT' || grp AS objectid, avg(x) AS px FROM mem JOIN pts USING (id) GROUP BY grp), own AS (SELECT DISTINCT 'CONNECTINGPOINT' || grp AS objectid, edge FROM mem JOIN pts USING (id)),
 j AS (SELECT o.objectid, o.edge, e.* EXCLUDE (objectid), px FROM own o JOIN cp USING (objectid) JOIN edges e ON e.objectid = o.edge), t AS (SELECT *, least(1, greatest(0, ((px - x0) * (x1 - x0) + (0 - y0) * (y1 - y0)) / (len * len))) AS t FROM j)
, kd AS (SELECT *, CASE WHEN t * len < 1 AND t * len <= (1 - t) * len THEN 'start' WHEN (1 - t) * len < 1 THEN 'end' ELSE 'cut' END AS kind FROM t), sd AS (SELECT *, CASE kind WHEN 'start' THEN 0 WHEN 'end' THEN 1 ELSE t END AS q FROM kd)
 SELECT objectid, edge, kind, round(q * len, 6) + 0.0 AS s, round(px - (x0 + (x1 - x0) * q), 6) + 0.0 AS dx, round(0 - (y0 + (y1 - y0) * q), 6) + 0.0 AS dy FROM sd""")
def step250(spark, d):
    groups = M.cut(M.pair_points(_points(spark, d), TN))
    cps = M.connecting_points(groups, net.boundary(spark, d)).select("objectid", "x", "y")
    own = groups.select(F.concat(F.lit("CONNECTINGPOINT"), "group").alias("objectid"), "edge").distinct()
    return rounded(M.connect_points(net.edges(spark, d), own.join(cps, "objectid"), TN), "s", "dx", "dy")


@query("d1_a7_mean_displacements", "SELECT round(avg(x1 - x0), 6) + 0.0 AS dx, round(avg(y1 - y0), 6) + 0.0 AS dy, x0 + 0.0 AS x, y0 + 0.0 AS y FROM edges GROUP BY x0, y0")
def d1(spark, d):
    e = net.edges(spark, d).select(F.col("x0").alias("x"), F.col("y0").alias("y"), F.expr("x1 - x0").alias("dx"), F.expr("y1 - y0").alias("dy"))
    at = e.select(G.vertex_key("x", "y").alias("v"), "x", "y").distinct()
    return rounded(M.mean_displacements(e).join(at, "v").select("dx", "dy", "x", "y"), "dx", "dy")


def _tiny(spark, d):
    return net.edges(spark, d).withColumns({"x1": F.expr("case when k % 101 = 0 then x0 + 0.1D else x1 end"), "y1": F.expr("case when k % 101 = 0 then y0 else y1 end")})


@query("h7_clean_tiny_edges", "SELECT objectid FROM edges WHERE k % 101 <> 0")
def h7(spark, d):
    return C.clean_tiny_edges(_tiny(spark, d), TN).select("objectid")


@query("h8_clean_parallel_edges", """, tw AS (SELECT objectid, p, x0, y0, x1, y1 FROM edges UNION ALL SELECT 'copy' || objectid, p, x0, y0, x1, y1 FROM edges WHERE k % 97 = 0),
 sc AS (SELECT *, least(x0 || ':' || y0, x1 || ':' || y1) AS a, greatest(x0 || ':' || y0, x1 || ':' || y1) AS b, round(CASE WHEN y0 = y1 THEN CASE WHEN (p = 0) = (y0 > 0) THEN 1 ELSE 0 END
  WHEN p = 0 THEN (greatest(0, greatest(y0, y1)) - greatest(0, least(y0, y1))) / abs(y1 - y0) ELSE (least(0, greatest(y0, y1)) - least(0, least(y0, y1))) / abs(y1 - y0) END, 9) AS score FROM tw)
 SELECT objectid FROM sc QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY score DESC, length(objectid), objectid) = 1""")
def h8(spark, d):
    e = net.edges(spark, d)
    twice = e.where("k % 97 = 0").withColumns({"objectid": F.concat(F.lit("copy"), "objectid")})
    return C.clean_parallel_edges(e.union(twice), net.land(spark, d), TN).select("objectid")


@query("a3_first_part_length", "SELECT i * 2 + p AS chain, round(coalesce(sum(len * CASE WHEN k % 5 = 0 THEN 0.5 ELSE 1 END) FILTER (m <= coalesce(brk, 1e18)), 0), 6) + 0.0 AS length FROM (SELECT *, min(CASE WHEN k % 5 = 0 THEN m END) OVER (PARTITION BY i, p) AS brk FROM edges) GROUP BY i, p")
def a3(spark, d):
    e = G.graph_edges(net.edges(spark, d)).select(F.expr("(m div 7) * 2 + p").alias("chain"), F.col("m").alias("pos"), "len", F.expr("case when k % 5 = 0 then 0.5D else 1D end").alias("ratio"))
    return rounded(C.first_part_length(e), "length")


@query("a5_a6_path_shares", """SELECT i * 2 + p AS chain, round(sum(len), 6) + 0.0 AS length, round(sum(len * (k % 10) / 10) / sum(len), 6) + 0.0 AS ratio, round(coalesce(sum(len) FILTER (fictitious = 'true'), 0) / sum(len), 6) + 0.0 AS share,
 coalesce(sum(len) FILTER (fictitious = 'true'), 0) / sum(len) > 0.1 OR coalesce(sum(len) FILTER (fictitious = 'true'), 0) > 20 AS fictitious FROM edges GROUP BY i, p""")
def a5(spark, d):
    e = G.graph_edges(net.edges(spark, d)).select(F.expr("(m div 7) * 2 + p").alias("chain"), "len", ((F.col("k") % 10) / 10).alias("ratio"), "fictitious")
    return rounded(C.path_ratio(e).join(C.fictitious_share(e, HY).drop("length"), "chain"), "length", "ratio", "share")


@query("n21_removable", "SELECT m AS path FROM (SELECT *, count(*) OVER (PARTITION BY x0, y0, x1, y1) AS n FROM edges) GROUP BY m HAVING bool_and(k % 11 <> 0 AND n = 1)")
def n21(spark, d):
    g = G.graph_edges(net.edges(spark, d))
    feature = F.when(F.col("k") % 11 == 0, F.concat(F.lit("CONNECTINGLINE"), "k")).otherwise(F.col("objectid"))
    paths = g.select(F.col("m").alias("path"), "v0", "v1")
    return C.removable(paths, g.select(feature.alias("origin"), "v0", "v1"))


@query("h4_clean_antennas")
def h4(spark, d):
    return C.clean_antennas(net.edges(spark, d), net.land(spark, d), TN).select("objectid")


@query("h2_clean_faces")
def h2(spark, d):
    return C.clean_faces(_noded(spark, d), net.land(spark, d), TN).select("objectid")


def _noded(spark, d):
    """The network noded, a piece to the country of its first origin."""
    s = G.planarize(net.edges(spark, d).select("k", *ENDS).withColumnRenamed("k", "id"), 1e4)
    s = M.cut(s.select(F.when(F.get("origins", F.lit(0)) % 2 == 0, "be").otherwise("fr").alias("country"), *ENDS))  # names are made again, not staged
    return G.graph_edges(s, 1e-4).select(F.concat_ws("|", "v0", "v1").alias("objectid"), "country", *ENDS)


@query("h3_clean_country_faces")
def h3(spark, d):
    return C.clean_country_faces(_noded(spark, d), net.land(spark, d), TN).select("objectid")


@query("n13_country_paths")
def n13(spark, d):
    e = _noded(spark, d)
    f = G.faces(G.graph_edges(e)).where("area > 0").join(e.select(F.col("objectid").alias("eid"), "country"), "eid")
    return G.country_paths(f, F.lit(False)).groupBy("face_id").agg((F.max("path") + 1).alias("n_paths"), F.count("*").alias("n_edges"))


@query("h9_paths_out_of_country")
def h9(spark, d):
    return C.paths_out_of_country(net.edges(spark, d), net.land(spark, d), "be")


@query("step270_connect_loose_ends")
def step270(spark, d):
    return rounded(C.connect_loose_ends(net.edges(spark, d), net.land(spark, d), TN), "x", "y")


@query("step270_split_at_meetings")
def step270_split(spark, d):
    e, land = net.edges(spark, d), net.land(spark, d)
    return rounded(C.split_at_meetings(C.move_ends(e, C.connect_loose_ends(e, land, TN)), land, TN).select("origin", "country", *ENDS), *ENDS)


@query("params_themes", "SELECT * FROM (VALUES ('tn', 25.0, 10.0, 5.0), ('hy', 35.0, 5.0, 5.0), ('ra', 25.0, 10.0, 15.0)) AS t(theme, undershoot, slim, merge_dist)", net=False)
def params(spark, d):
    ini = "[params]\necl_slim_surface_width = 10\n[be#fr]\necl_slim_surface_width = 5\n"
    rows = [(t, p.cp_undershoot_dist, p.ecl_slim_surface_width, p.cp_merge_dist) for t, p in ((t, load(t, ini_text=ini if t == "hy" else None)) for t in ("tn", "hy", "ra"))]
    return spark.createDataFrame(rows, "theme string, undershoot double, slim double, merge_dist double")


@query("pipeline_hy_201_to_230")
def pipeline_hy(spark, d):
    """The watercourse theme from its first step to the import of connecting lines."""
    state = State(net.edges(spark, d), None, None, net.boundary(spark, d), net.land(spark, d), net.water(spark, d))
    return rounded(run(state, "hy", HY, 201, 230).edges.select("objectid", "country", *ENDS), *ENDS)
