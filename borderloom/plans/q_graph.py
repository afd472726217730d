"""Queries of graphs, chains, planar graphs and faces."""

from __future__ import annotations

from pyspark.sql import functions as F

from borderloom.operators import graph as G
from borderloom.plans.registry import query, rounded
from borderloom.sources import network as net

#: Vertices are exact in the stand-in network, so SQL names them by their coordinates.
HALF = """, half AS (SELECT k AS eid, x0 AS x, y0 AS y, x1 AS xw, y1 AS yw, i, p, form_of_way FROM edges UNION ALL SELECT k, x1, y1, x0, y0, i, p, form_of_way FROM edges),
 deg AS (SELECT x, y, count(*) AS degree, min(eid) AS a, max(eid) AS b, bool_or(p = 0) AND bool_or(p = 1) AS mixed FROM half GROUP BY x, y)"""


def graph(spark, d):
    return G.graph_edges(net.edges(spark, d))


@query("n1_n4_degrees", HALF + " SELECT x + 0.0 AS x, y + 0.0 AS y, degree FROM deg")
def n1(spark, d):
    return G.graph_vertices(G.half_edges(graph(spark, d))).select("x", "y", "degree")


@query("n6_j20_parallel_edges", """, w AS (SELECT k, least(x0 || ':' || y0, x1 || ':' || y1) AS a, greatest(x0 || ':' || y0, x1 || ':' || y1) AS b, len FROM edges UNION ALL SELECT -k - 1, least(x0 || ':' || y0, x1 || ':' || y1), greatest(x0 || ':' || y0, x1 || ':' || y1), len FROM edges WHERE k % 97 = 0)
 SELECT list_sort(list(k)) AS ks, count(*) AS n, round(min(len), 6) + 0.0 AS len FROM w GROUP BY a, b HAVING count(*) > 1""")
def n6(spark, d):
    e = net.edges(spark, d)
    twice = e.where("k % 97 = 0").withColumn("k", -F.col("k") - 1).withColumns({"x0": F.col("x1"), "y0": F.col("y1"), "x1": F.col("x0"), "y1": F.col("y0")})
    g = G.graph_edges(e.union(twice))
    pairs = g.groupBy(F.least("v0", "v1").alias("a"), F.greatest("v0", "v1").alias("b")).agg(F.sort_array(F.collect_list("k")).alias("ks"), F.count("*").alias("n"), F.min("len").alias("len"))
    return rounded(pairs.where("n > 1").select("ks", "n", "len"), "len")


@query("n8_j21_origin_flags", "SELECT objectid AS eid, r < 5 AS is_cl, country, 't' || (m % 3) AS w_tag, CASE WHEN r < 5 THEN ['be', 'fr'] ELSE [country] END AS countries FROM edges")
def n8(spark, d):
    e = net.edges(spark, d)
    first = e.select(F.col("objectid").alias("eid"), F.lit(0).alias("pos"), F.col("objectid").alias("origin"), "country", F.concat(F.lit("t"), (F.col("m") % 3)).alias("w_tag"))
    second = e.where("m % 7 < 5").select(F.col("objectid").alias("eid"), F.lit(1).alias("pos"), F.concat(F.lit("CONNECTINGLINE"), "m").alias("origin"), F.lit(net.PAIR).alias("country"), F.lit(None).cast("string").alias("w_tag"))
    return G.origin_flags(first.union(second))


@query("n20_origin_for_country", "SELECT objectid, objectid AS be_origin, 'x' AS nl_origin FROM edges")
def n20(spark, d):
    e = net.edges(spark, d)
    origins, countries = F.array("objectid", F.lit("x")), F.array(F.lit("be"), F.lit("fr"))
    return e.select("objectid", G.origin_for(origins, countries, "be").alias("be_origin"), G.origin_for(origins, countries, "nl").alias("nl_origin"))


@query("n15_chains", HALF + """, RECURSIVE_LINKS AS (SELECT a, b FROM deg WHERE degree = 2 AND a <> b), both_ways AS (SELECT a AS n, b AS m FROM RECURSIVE_LINKS UNION ALL SELECT b, a FROM RECURSIVE_LINKS),
 lab AS (SELECT k, least(k, coalesce((SELECT min(m) FROM both_ways WHERE n = k), k)) AS c FROM edges),
 l2 AS (SELECT lab.k, least(lab.c, coalesce(min(o.c), lab.c)) AS c FROM lab LEFT JOIN both_ways w ON w.n = lab.k LEFT JOIN lab o ON o.k = w.m GROUP BY lab.k, lab.c),
 l3 AS (SELECT lab.k, least(lab.c, coalesce(min(o.c), lab.c)) AS c FROM l2 lab LEFT JOIN both_ways w ON w.n = lab.k LEFT JOIN l2 o ON o.k = w.m GROUP BY lab.k, lab.c),
 l4 AS (SELECT lab.k, least(lab.c, coalesce(min(o.c), lab.c)) AS c FROM l3 lab LEFT JOIN both_ways w ON w.n = lab.k LEFT JOIN l3 o ON o.k = w.m GROUP BY lab.k, lab.c),
 l5 AS (SELECT lab.k, least(lab.c, coalesce(min(o.c), lab.c)) AS c FROM l4 lab LEFT JOIN both_ways w ON w.n = lab.k LEFT JOIN l4 o ON o.k = w.m GROUP BY lab.k, lab.c),
 l6 AS (SELECT lab.k, least(lab.c, coalesce(min(o.c), lab.c)) AS c FROM l5 lab LEFT JOIN both_ways w ON w.n = lab.k LEFT JOIN l5 o ON o.k = w.m GROUP BY lab.k, lab.c),
 l7 AS (SELECT lab.k, least(lab.c, coalesce(min(o.c), lab.c)) AS c FROM l6 lab LEFT JOIN both_ways w ON w.n = lab.k LEFT JOIN l6 o ON o.k = w.m GROUP BY lab.k, lab.c)
 SELECT c AS chain, count(*) AS n_edges, round(sum(len), 6) + 0.0 AS length, arg_min(edges.k, round(-len, 9) * 1e7 + edges.k) AS pivot FROM l7 JOIN edges USING (k) GROUP BY c""")
def n15(spark, d):
    ch = G.chains(graph(spark, d), id_col="k")
    return rounded(ch.select("chain", "n_edges", "length", "pivot").distinct(), "length")


@query("n11_antennas", HALF.replace("WITH", "") + """, tips AS (SELECT h.eid, h.x, h.y, h.xw, h.yw FROM half h JOIN deg USING (x, y) WHERE degree = 1),
 s1 AS (SELECT x AS tx, y AS ty, eid, xw AS x, yw AS y, 1 AS n FROM tips),
 s2 AS (SELECT tx, ty, h.eid, h.xw AS x, h.yw AS y, n + 1 AS n FROM s1 JOIN deg ON deg.x = s1.x AND deg.y = s1.y AND degree = 2 JOIN half h ON h.x = s1.x AND h.y = s1.y AND h.eid <> s1.eid),
 s3 AS (SELECT tx, ty, h.eid, h.xw AS x, h.yw AS y, n + 1 AS n FROM s2 JOIN deg ON deg.x = s2.x AND deg.y = s2.y AND degree = 2 JOIN half h ON h.x = s2.x AND h.y = s2.y AND h.eid <> s2.eid),
 s4 AS (SELECT tx, ty, h.eid, h.xw AS x, h.yw AS y, n + 1 AS n FROM s3 JOIN deg ON deg.x = s3.x AND deg.y = s3.y AND degree = 2 JOIN half h ON h.x = s3.x AND h.y = s3.y AND h.eid <> s3.eid),
 s5 AS (SELECT tx, ty, h.eid, h.xw AS x, h.yw AS y, n + 1 AS n FROM s4 JOIN deg ON deg.x = s4.x AND deg.y = s4.y AND degree = 2 JOIN half h ON h.x = s4.x AND h.y = s4.y AND h.eid <> s4.eid),
 s6 AS (SELECT tx, ty, h.eid, h.xw AS x, h.yw AS y, n + 1 AS n FROM s5 JOIN deg ON deg.x = s5.x AND deg.y = s5.y AND degree = 2 JOIN half h ON h.x = s5.x AND h.y = s5.y AND h.eid <> s5.eid),
 steps AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3 UNION ALL SELECT * FROM s4 UNION ALL SELECT * FROM s5 UNION ALL SELECT * FROM s6),
 walk AS (SELECT tx, ty, count(*) AS n_edges, sum(len) AS length, list_sort(list(eid)) AS es FROM steps JOIN edges ON eid = k GROUP BY tx, ty)
 SELECT DISTINCT es[1] AS chain, n_edges, round(length, 6) + 0.0 AS length FROM walk""")
def n11(spark, d):
    return rounded(G.antennas(graph(spark, d), id_col="k").select("chain", "n_edges", "length"), "length")


@query("n9_n10_merge_translate", HALF + " SELECT x + 0.5 AS x, y - 0.25 AS y, degree FROM deg WHERE degree = 3 UNION ALL SELECT x + 0.0, y + 0.0, degree FROM deg WHERE degree <> 3")
def n9(spark, d):
    v = G.graph_vertices(G.half_edges(graph(spark, d)))
    moves = v.where("degree = 3").select("v", F.explode(F.array(F.struct(F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy")), F.struct(F.lit(1.0).alias("dx"), F.lit(-0.5).alias("dy")))).alias("m")).select("v", "m.dx", "m.dy")
    return G.translate_vertices(v, moves).select("x", "y", "degree")


@query("n19_closure", "SELECT k AS old, k - k % 50 AS new FROM edges WHERE k % 50 <> 0")
def n19(spark, d):
    return G.closure(net.edges(spark, d).where("k % 50 <> 0").select(F.col("k").alias("old"), (F.col("k") - 1).alias("new")))


_PLANAR = """, pr AS (SELECT a.k, a.x0, a.y0, a.x1, a.y1, b.x0 AS u0, b.y0 AS v0, b.x1 AS u1, b.y1 AS v1 FROM edges a JOIN edges b ON b.i BETWEEN a.i - 1 AND a.i + 1 AND a.k <> b.k),
 tu AS (SELECT *, CASE WHEN (x1 - x0) * (v1 - v0) - (y1 - y0) * (u1 - u0) <> 0 THEN ((u0 - x0) * (v1 - v0) - (v0 - y0) * (u1 - u0)) / ((x1 - x0) * (v1 - v0) - (y1 - y0) * (u1 - u0)) END AS t,
   CASE WHEN (u1 - u0) * (y1 - y0) - (v1 - v0) * (x1 - x0) <> 0 THEN ((x0 - u0) * (y1 - y0) - (y0 - v0) * (x1 - x0)) / ((u1 - u0) * (y1 - y0) - (v1 - v0) * (x1 - x0)) END AS u FROM pr),
 tips AS (SELECT *, least(1, greatest(0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t FROM (SELECT *, u0 AS px, v0 AS py FROM pr UNION ALL SELECT *, u1, v1 FROM pr)),
 mk AS (SELECT k, t, floor((x0 + (x1 - x0) * t) * 1e4 + 0.5) / 1e4 AS x, floor((y0 + (y1 - y0) * t) * 1e4 + 0.5) / 1e4 AS y FROM tu WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1
   UNION ALL SELECT k, t, floor((x0 + (x1 - x0) * t) * 1e4 + 0.5) / 1e4, floor((y0 + (y1 - y0) * t) * 1e4 + 0.5) / 1e4 FROM tips WHERE sqrt(pow(px - (x0 + (x1 - x0) * t), 2) + pow(py - (y0 + (y1 - y0) * t), 2)) < 0.5e-4
   UNION ALL SELECT k, 0, floor(x0 * 1e4 + 0.5) / 1e4, floor(y0 * 1e4 + 0.5) / 1e4 FROM edges UNION ALL SELECT k, 1, floor(x1 * 1e4 + 0.5) / 1e4, floor(y1 * 1e4 + 0.5) / 1e4 FROM edges),
 pt AS (SELECT k, x, y, min(t) AS t FROM mk GROUP BY k, x, y),
 sb AS (SELECT k, x, y, lead(x) OVER (PARTITION BY k ORDER BY t) AS xn, lead(y) OVER (PARTITION BY k ORDER BY t) AS yn FROM pt QUALIFY xn IS NOT NULL),
 planar AS (SELECT CASE WHEN (x, y) <= (xn, yn) THEN x ELSE xn END AS x0, CASE WHEN (x, y) <= (xn, yn) THEN y ELSE yn END AS y0, CASE WHEN (x, y) <= (xn, yn) THEN xn ELSE x END AS x1, CASE WHEN (x, y) <= (xn, yn) THEN yn ELSE y END AS y1, list_sort(list(DISTINCT k)) AS origins FROM sb GROUP BY ALL HAVING TRUE)"""


def planar(spark, d):
    return G.planarize(net.edges(spark, d).select(F.col("k").alias("id"), "x0", "y0", "x1", "y1"), 1e4)


@query("n2_planarize", _PLANAR.replace(" GROUP BY ALL HAVING TRUE", " GROUP BY 1, 2, 3, 4") + " SELECT x0 + 0.0 AS x0, y0 + 0.0 AS y0, x1 + 0.0 AS x1, y1 + 0.0 AS y1, origins FROM planar")
def n2(spark, d):
    return rounded(planar(spark, d).select("x0", "y0", "x1", "y1", "origins"), "x0", "y0", "x1", "y1", digits=4)


@query("n5_n8_induced_edges", _PLANAR.replace(" GROUP BY ALL HAVING TRUE", " GROUP BY 1, 2, 3, 4") + " SELECT origin, count(*) AS n FROM (SELECT unnest(origins) AS origin FROM planar) GROUP BY origin")
def n5(spark, d):
    return G.induced(planar(spark, d)).groupBy("origin").agg(F.count("*").alias("n"))


@query("n3_faces")
def n3(spark, d):
    sub = G.graph_edges(G.cut(planar(spark, d).select("x0", "y0", "x1", "y1")), 1e-4)  # names of vertices aren't staged
    return rounded(G.faces(sub.withColumn("objectid", F.concat_ws("|", "v0", "v1"))).groupBy("root", "face_id").agg(F.count("*").alias("n_edges"), F.first("area").alias("area")), "area")


@query("h9_shortest_paths", """, h2 AS (SELECT x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_, len, k FROM edges UNION ALL SELECT x1, y1, x0, y0, len, k FROM edges),
 d1 AS (SELECT b.k AS src, h2.bx AS x, h2.by_ AS y, h2.len AS d FROM edges b JOIN h2 ON h2.ax = b.x0 AND h2.ay = b.y0 WHERE b.r = 6 AND h2.len <= 60 UNION ALL SELECT k, x0, y0, 0 FROM edges WHERE r = 6),
 d2 AS (SELECT src, h2.bx AS x, h2.by_ AS y, d + h2.len AS d FROM d1 JOIN h2 ON h2.ax = x AND h2.ay = y WHERE d + h2.len <= 60 UNION ALL SELECT * FROM d1),
 d3 AS (SELECT src, h2.bx AS x, h2.by_ AS y, d + h2.len AS d FROM d2 JOIN h2 ON h2.ax = x AND h2.ay = y WHERE d + h2.len <= 60 UNION ALL SELECT * FROM d2),
 d4 AS (SELECT src, h2.bx AS x, h2.by_ AS y, d + h2.len AS d FROM d3 JOIN h2 ON h2.ax = x AND h2.ay = y WHERE d + h2.len <= 60 UNION ALL SELECT * FROM d3)
 SELECT src, round(min(d), 6) + 0.0 AS dist, x + 0.0 AS x, y + 0.0 AS y FROM d4 GROUP BY src, x, y""")
def h9(spark, d):
    g = graph(spark, d)
    src = g.where("m % 7 = 6").select(F.col("v0").alias("v"), F.col("k").alias("src"))
    best = G.shortest_paths(g, src.select("v").distinct(), 60.0)
    at = G.graph_vertices(G.half_edges(g)).select("v", "x", "y")
    return rounded(best.join(src.withColumnRenamed("v", "source"), "source").join(at, "v").select("src", "dist", "x", "y"), "dist")
