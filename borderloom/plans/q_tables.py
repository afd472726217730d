"""Queries of table operations, predicates, strings and joins by attribute or place."""

from __future__ import annotations

from pyspark.sql import functions as F

from borderloom.functions import geometry as g
from borderloom.functions import strings as t
from borderloom.operators import coverage, spatial, tables
from borderloom.plans.registry import CLIP, query, rounded
from borderloom.sources import network as net


@query("s1_p7_scan_filter", "SELECT objectid, country, form_of_way FROM edges WHERE form_of_way = 'road' AND k % 10 = 3")
def s1(spark, d):
    return tables.scan(net.edges(spark, d), "form_of_way = 'road' AND k % 10 = 3").select("objectid", "country", "form_of_way")


@query("s2_bbox_scan", "SELECT objectid FROM edges WHERE greatest(x0, x1) >= 100 AND least(x0, x1) <= 5000 AND greatest(y0, y1) >= -10 AND least(y0, y1) <= 20")
def s2(spark, d):
    return tables.scan(net.edges(spark, d), box=(100, -10, 5000, 20)).select("objectid")


_IDS = ", ids AS (SELECT CAST(k * 3 AS VARCHAR) AS objectid FROM edges WHERE k % 5 = 0)"


@query("s3_lookup", _IDS + " SELECT ids.objectid, e.country, e.fictitious FROM ids LEFT JOIN edges e USING (objectid)")
def s3(spark, d):
    e = net.edges(spark, d)
    ids = e.where("k % 5 = 0").select((F.col("k") * 3).cast("string").alias("objectid"))
    return tables.lookup(ids, e.select("objectid", "country", "fictitious"))


@query("s4_having_ids", _IDS + " SELECT objectid, country FROM edges WHERE objectid IN (SELECT objectid FROM ids)")
def s4(spark, d):
    e = net.edges(spark, d)
    return tables.having_ids(e, e.where("k % 5 = 0").select((F.col("k") * 3).cast("string").alias("objectid"))).select("objectid", "country")


@query("s5_count", "SELECT country, count(*) AS n FROM edges GROUP BY country")
def s5(spark, d):
    return net.edges(spark, d).groupBy("country").agg(F.count("*").alias("n"))


@query("s6_s9_clone_insert", "SELECT objectid, country, CAST(NULL AS VARCHAR) AS linked_feat_id FROM edges WHERE k % 4 = 1")
def s6(spark, d):
    e = net.edges(spark, d).select("objectid", "country", "k")
    empty = tables.empty_clone(e.select("objectid", "country"), {"linked_feat_id": "string"})
    return tables.insert(empty, e.where("k % 4 = 1").select("objectid", "country"))


@query("s10_update", "SELECT objectid, CASE WHEN k % 97 = 0 THEN 'patched' ELSE fictitious END AS fictitious, country FROM edges")
def s10(spark, d):
    e = net.edges(spark, d).select("objectid", "fictitious", "country", "k")
    return tables.update(e, e.where("k % 97 = 0").select("objectid", F.lit("patched").alias("fictitious"))).drop("k")


@query("s11_delete_ids", "SELECT objectid FROM edges WHERE k % 3 <> 0")
def s11(spark, d):
    e = net.edges(spark, d)
    return tables.delete_ids(e, e.where("k % 3 = 0")).select("objectid")


@query("s12_delete_where", "SELECT objectid FROM (SELECT objectid, country FROM edges UNION ALL SELECT objectid, country FROM cls) WHERE country LIKE '%#%'")
def s12(spark, d):
    both = tables.insert(net.edges(spark, d).select("objectid", "country"), net.connecting_lines(spark, d).select("objectid", "country"))
    return tables.delete_where(both, ~t.is_double("country")).select("objectid")


@query("s13_s14_set_reset_column", "SELECT objectid, CASE WHEN country = 'be' THEN 'cleaned' ELSE fictitious END AS fictitious, CAST(NULL AS VARCHAR) AS w_tag FROM edges")
def s13(spark, d):
    e = tables.set_column(net.edges(spark, d), "fictitious", F.lit("cleaned"), F.col("country") == "be")
    return tables.reset_column(e, "w_tag").select("objectid", "fictitious", "w_tag")


@query("s15_sequential_ids", "SELECT 'CONNECTINGPOINT' || row_number() OVER (ORDER BY k) AS id, k FROM edges")
def s15(spark, d):
    return tables.with_ids(net.edges(spark, d).select("k"), "CONNECTINGPOINT", ["k"], "id").select("id", "k")


@query("s20_import_connecting_lines", "SELECT objectid, country, fictitious FROM edges UNION ALL SELECT objectid, country, NULL FROM cls")
def s20(spark, d):
    return tables.import_connecting_lines(net.edges(spark, d).select("objectid", "country", "fictitious"), net.connecting_lines(spark, d), net.PAIR)


@query(
    "p1_p6_predicates",
    """SELECT objectid, country = 'be' AS is_be, contains(country, 'e') AS has_e, NOT contains(country, '#') AS single, objectid <> '7' AS not_7, tag IS NOT NULL AS tagged,
    (country = 'be' AND status = 'F') OR priority = '5-LOW' AS either FROM (SELECT *, CASE WHEN k % 3 = 0 THEN 'x' END AS tag FROM edges)""",
)
def p1(spark, d):
    e = net.edges(spark, d).withColumn("tag", F.expr("case when k % 3 = 0 then 'x' end"))
    return e.select(
        "objectid", (F.col("country") == "be").alias("is_be"), F.col("country").contains("e").alias("has_e"), (~t.is_double("country")).alias("single"), (F.col("objectid") != "7").alias("not_7"),
        F.col("tag").isNotNull().alias("tagged"), (((F.col("country") == "be") & (F.col("status") == "F")) | (F.col("priority") == "5-LOW")).alias("either"),
    )


@query("p8_intersects_area", CLIP + " SELECT DISTINCT objectid FROM clip WHERE t0 < t1")
def p8(spark, d):
    e = net.edges(spark, d).withColumn("seg_id", F.col("objectid"))
    return coverage.covered_parts(e, net.water(spark, d)).select(F.col("seg_id").alias("objectid")).distinct()


_CROSS = """, hit AS (SELECT e.objectid, ((c.x0 - e.x0) * (c.y1 - c.y0) - (c.y0 - e.y0) * (c.x1 - c.x0)) / nullif((e.x1 - e.x0) * (c.y1 - c.y0) - (e.y1 - e.y0) * (c.x1 - c.x0), 0) AS t,
  ((e.x0 - c.x0) * (e.y1 - e.y0) - (e.y0 - c.y0) * (e.x1 - e.x0)) / nullif((c.x1 - c.x0) * (e.y1 - e.y0) - (c.y1 - c.y0) * (e.x1 - e.x0), 0) AS u FROM edges e JOIN cls c ON c.m // 7 BETWEEN e.i - 1 AND e.i + 1)"""


@query("p9_intersects_connecting_lines", _CROSS + " SELECT DISTINCT objectid FROM hit WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1")
def p9(spark, d):
    e = net.edges(spark, d).withColumnRenamed("objectid", "id")
    c = net.connecting_lines(spark, d).withColumnRenamed("objectid", "id")
    return spatial.crossings(e, c).select(F.col("a_id").alias("objectid")).distinct()


@query("p10_short", "SELECT objectid, round(len, 6) + 0.0 AS len FROM edges WHERE len < 30")
def p10(spark, d):
    return rounded(net.edges(spark, d).select("objectid", g.array_length("geom").alias("len")).where("len < 30"), "len")


@query("p11_middle_outside_country", "SELECT objectid FROM edges WHERE NOT coalesce(CASE WHEN p = 0 THEN y0 + (y1 - y0) * 0.5 >= 0 ELSE y0 + (y1 - y0) * 0.5 < 0 END, FALSE)")
def p11(spark, d):
    e = net.edges(spark, d).withColumn("mid", g.middle_point("geom"))
    land = net.land(spark, d).withColumn("poly_id", F.struct("country", "poly_id"))
    inside = spatial.points_in(e.select(F.struct("objectid", "country").alias("id"), "mid.x", "mid.y"), land).where("p_id.country = poly_id.country")
    return e.select("objectid").join(inside.select(F.col("p_id.objectid").alias("objectid")), "objectid", "left_anti")


@query("p12_p14_typed_features", "SELECT 'B' || i AS id FROM chunks UNION ALL SELECT 'be' || i FROM chunks")
def p12(spark, d):
    b = net.boundary(spark, d).where((F.col("boundary_type") == "international_boundary") | F.col("boundary_type").contains("coastline_sea_limit"))
    land = net.land(spark, d).where((F.col("land_cover_type") == "land_area") & (F.col("country") == "be"))
    return b.select(F.col("objectid").alias("id")).union(land.select("poly_id"))


@query("p13_common_columns", "SELECT objectid, country FROM edges")
def p13(spark, d):
    return tables.common_columns(net.edges(spark, d), net.connecting_lines(spark, d).select("objectid", "country", "linked_feat_id"))


@query(
    "t1_t7_strings",
    """SELECT objectid, split_part(linked_feat_id, '#', 1) AS first, split_part(linked_feat_id, '#', 2) AS second, contains(objectid, 'CONNECTINGLINE') AS protected, 'fr' || '/' || objectid AS joined,
    CASE WHEN m % 2 = 0 THEN 'a' ELSE 'a#b' END AS merged, CASE WHEN m % 3 = 0 THEN 'y' END AS common FROM cls""",
)
def t1(spark, d):
    c = net.connecting_lines(spark, d)
    return c.select(
        "objectid", F.get(t.values("linked_feat_id"), F.lit(0)).alias("first"), F.get(t.values("linked_feat_id"), F.lit(1)).alias("second"), t.is_protected("objectid").alias("protected"),
        t.joined(F.lit("fr"), "objectid", sep="/").alias("joined"), t.merged(F.lit("a"), F.expr("case when m % 2 = 0 then 'a' else 'b' end")).alias("merged"),
        t.common_tag(F.lit("x#y"), F.expr("case when m % 3 = 0 then 'y#z' when m % 3 = 1 then 'x#y' else 'z' end")).alias("common"),
    )


@query("t5_ordered_pair", "SELECT objectid, linked_feat_id AS pair FROM cls")
def t5(spark, d):
    c = net.connecting_lines(spark, d)
    ids = t.values("linked_feat_id")
    return c.select("objectid", t.ordered_pair(F.lit("fr"), F.get(ids, F.lit(1)), F.lit("be"), F.get(ids, F.lit(0))).alias("pair"))


@query("t6_merged_json", "SELECT objectid, CASE WHEN k % 2 = 0 THEN '[\"n1\",\"n2\"]' ELSE '[\"n1\"]' END AS names FROM edges")
def t6(spark, d):
    return net.edges(spark, d).select("objectid", t.merged_json(F.lit('["n1"]'), F.expr("case when k % 2 = 0 then '[\"n2\",\"n1\"]' end")).alias("names"))


@query("j14_linked_id", "SELECT objectid, split_part(linked_feat_id, '#', 1) AS be, split_part(linked_feat_id, '#', 2) AS fr, CAST(NULL AS VARCHAR) AS nl FROM cls")
def j14(spark, d):
    return net.connecting_lines(spark, d).select("objectid", *[t.linked_id("linked_feat_id", "country", F.lit(c)).alias(c) for c in ("be", "fr", "nl")])


@query("j11_linked_edges", "SELECT c.objectid, a.form_of_way AS way1, b.form_of_way AS way2 FROM cls c JOIN edges a ON a.objectid = split_part(c.linked_feat_id, '#', 1) JOIN edges b ON b.objectid = split_part(c.linked_feat_id, '#', 2)")
def j11(spark, d):
    e = net.edges(spark, d).select("objectid", "form_of_way")
    c = net.connecting_lines(spark, d)
    ids = t.values("linked_feat_id")
    one = e.select(F.col("objectid").alias("id1"), F.col("form_of_way").alias("way1"))
    two = e.select(F.col("objectid").alias("id2"), F.col("form_of_way").alias("way2"))
    return c.select("objectid", F.get(ids, F.lit(0)).alias("id1"), F.get(ids, F.lit(1)).alias("id2")).join(one, "id1", "left").join(two, "id2", "left").select("objectid", "way1", "way2")


_PS = "least(1, greatest(0, ((px - u0) * (u1 - u0) + (py - v0) * (v1 - v0)) / ((u1 - u0) * (u1 - u0) + (v1 - v0) * (v1 - v0))))"


@query(
    "j5_j16_nearest_connecting_line",
    f""", pairs AS (SELECT e.objectid, c.objectid AS cl, e.x0 AS px, e.y0 AS py, c.x0 AS u0, c.y0 AS v0, c.x1 AS u1, c.y1 AS v1 FROM edges e JOIN cls c ON c.m // 7 BETWEEN e.i - 1 AND e.i + 1),
    dist AS (SELECT *, sqrt(pow(px - (u0 + (u1 - u0) * {_PS}), 2) + pow(py - (v0 + (v1 - v0) * {_PS}), 2)) AS d FROM pairs)
    SELECT objectid, cl, round(d, 6) + 0.0 AS dist FROM dist WHERE d < 5 QUALIFY row_number() OVER (PARTITION BY objectid ORDER BY round(d, 9), cl) = 1""",
)
def j5(spark, d):
    p = net.edges(spark, d).select(F.col("objectid").alias("id"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    c = net.connecting_lines(spark, d).withColumnRenamed("objectid", "id")
    near = spatial.best(spatial.points_near_segments(p, c, 5.0), "p_id", "s_id")
    return rounded(near.select(F.col("p_id").alias("objectid"), F.col("s_id").alias("cl"), "dist"), "dist")


_NEAR = """, a AS (SELECT k, x0 AS x, y0 AS y, i FROM edges WHERE p = 0), b AS (SELECT k, x0 AS x, y0 AS y, i FROM edges WHERE p = 1),
 pairs AS (SELECT a.k AS a_id, b.k AS b_id, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS dist FROM a JOIN b ON b.i BETWEEN a.i - 1 AND a.i + 1 WHERE dist < 10),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY round(dist, 9), b_id) AS ra, row_number() OVER (PARTITION BY b_id ORDER BY round(dist, 9), a_id) AS rb FROM pairs)"""


def _starts(spark, d, p):
    return net.edges(spark, d).where(f"p = {p}").select(F.col("k").alias("id"), F.col("x0").alias("x"), F.col("y0").alias("y"))


@query("j7_points_near", _NEAR + " SELECT a_id, b_id, round(dist, 6) + 0.0 AS dist FROM pairs")
def j7(spark, d):
    return rounded(spatial.points_near(_starts(spark, d, 0), _starts(spark, d, 1), 10.0), "dist")


@query("j8_mutual_best", _NEAR + " SELECT a_id, b_id, round(dist, 6) + 0.0 AS dist FROM ranked WHERE ra = 1 AND rb = 1")
def j8(spark, d):
    return rounded(spatial.mutual_best(spatial.points_near(_starts(spark, d, 0), _starts(spark, d, 1), 10.0)), "dist")


@query("j4_g14_border_crossings", "SELECT objectid, round(x0 + (x1 - x0) * (y0 / (y0 - y1)), 6) + 0.0 AS x FROM edges WHERE y0 <> y1 AND y0 / (y0 - y1) BETWEEN 0 AND 1")
def j4(spark, d):
    e = net.edges(spark, d).withColumnRenamed("objectid", "id")
    b = net.boundary(spark, d).withColumnRenamed("objectid", "id")
    return rounded(spatial.crossings(e, b).select(F.col("a_id").alias("objectid"), F.round("x", 6).alias("x")).distinct(), "x")


@query("a1_covered_ratio", CLIP + """, runs AS (SELECT *, max(t1) OVER (PARTITION BY objectid ORDER BY t0, t1, poly_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM clip WHERE t0 < t1),
 inside AS (SELECT objectid, sum(greatest(0, t1 - greatest(t0, coalesce(reach, 0)))) AS share FROM runs GROUP BY objectid)
 SELECT objectid, round(coalesce(share, 0), 6) + 0.0 AS ratio FROM edges LEFT JOIN inside USING (objectid)""")
def a1(spark, d):
    e = net.edges(spark, d).withColumn("pos", F.lit(0))
    return rounded(coverage.covered_ratio(e, net.water(spark, d)).select("objectid", "ratio"), "ratio")


@query("a2_in_country_ratio", "SELECT objectid, round(CASE WHEN y0 = y1 THEN CASE WHEN (p = 0) = (y0 > 0) THEN 1 ELSE 0 END WHEN p = 0 THEN (greatest(0, greatest(y0, y1)) - greatest(0, least(y0, y1))) / abs(y1 - y0) ELSE (least(0, greatest(y0, y1)) - least(0, least(y0, y1))) / abs(y1 - y0) END, 6) + 0.0 AS ratio FROM edges WHERE y0 <> y1")
def a2(spark, d):
    e = net.edges(spark, d).where("y0 <> y1").withColumn("pos", F.lit(0))
    return rounded(coverage.covered_ratio(e, net.land(spark, d)).select("objectid", "ratio"), "ratio")


@query("a8_a10_a11_grouped", """SELECT i, p, count(DISTINCT form_of_way) AS ways, list_sort(list(k)) AS ks, min_by(k, round(len, 9) * 1e9 + k / 1e6) AS shortest FROM edges GROUP BY i, p""")
def a8(spark, d):
    e = net.edges(spark, d).withColumn("len", g.distance("x0", "y0", "x1", "y1"))
    out = e.groupBy(F.expr("m div 7").alias("i"), "p").agg(F.countDistinct("form_of_way").alias("ways"), F.sort_array(F.collect_list("k")).alias("ks"), F.min_by("k", F.struct(F.round("len", 9), "k")).alias("shortest"))
    return out
