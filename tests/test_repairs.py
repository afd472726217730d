"""Rows are neither lost nor doubled where edges are numbered, cut and put in order."""

import random

from pyspark.sql import functions as F

from borderloom.operators import cleaning as C
from borderloom.operators import graph as G
from borderloom.operators import matching as M
from borderloom.operators import tables
from borderloom.plans.params import load

TN = load("tn")
EDGE = "objectid string, country string, x0 double, y0 double, x1 double, y1 double"


def test_ids_over_many_partitions(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        df = spark.range(300_000).select("id", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(k)), 256).alias(f"wide{k}") for k in range(3)])
        got = tables.with_ids(df, "N", ["id"])
        row = got.agg(F.count("*").alias("n"), F.countDistinct("objectid").alias("ids"), F.sum((F.expr("cast(substring(objectid, 2) as long)") != F.col("id") + 1).cast("int")).alias("wrong")).first()
        assert (row.n, row.ids, row.wrong) == (300_000, 300_000, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert tables.with_ids(df.limit(0), "N", ["id"]).count() == 0


def test_parts_between_lines_stay(spark):
    edges = spark.createDataFrame([("e", "be", 0.0, 0.0, 100.0, 0.0), ("f", "be", 0.0, 5.0, 10.0, 5.0), ("g", "be", 0.0, 9.0, 30.0, 9.0)], EDGE)
    parts = spark.createDataFrame([("e", 10.0, 20.0), ("e", 90.0, 80.0), ("e", 15.0, 25.0), ("g", 0.0, 30.0)], "edge string, s_from double, s_to double")
    got = {(r.objectid, r.x0, r.x1) for r in M.without_parts(edges, parts).collect()}
    assert got == {("e/1", 0.0, 10.0), ("e/2", 25.0, 80.0), ("e/3", 90.0, 100.0), ("f", 0.0, 10.0)}


def test_every_point_cuts_its_edge(spark):
    edges = spark.createDataFrame([("e", "be", 0.0, 0.0, 100.0, 0.0), ("f", "be", 0.0, 5.0, 10.0, 5.0), ("g", "fr", 0.0, 9.0, 30.0, 9.0)], EDGE)
    found = [("p", "e", "cut", 70.0, 70.0, 1.0), ("q", "e", "cut", 30.0, 30.0, -1.0), ("r", "e", "end", 100.0, 100.5, 0.0), ("s", "f", "start", 0.0, -0.5, 5.0)]
    got = {(r.objectid, r.x0, r.y0, r.x1, r.y1) for r in M.cut_at_points(edges, spark.createDataFrame(found, "objectid string, edge string, kind string, s double, x double, y double")).collect()}
    assert got == {("e/1", 0.0, 0.0, 30.0, -1.0), ("e/2", 30.0, -1.0, 70.0, 1.0), ("e/3", 70.0, 1.0, 100.5, 0.0), ("f", -0.5, 5.0, 10.0, 5.0), ("g", 0.0, 9.0, 30.0, 9.0)}


def test_positions_along_a_chain(spark):
    rng = random.Random(3)
    order = list(range(23))
    rng.shuffle(order)
    rows = []
    for place, name in enumerate(order):
        ends = [(float(place), 0.0), (place + 1.0, 0.0)]
        a, b = ends if rng.random() < 0.5 else ends[::-1]
        rows.append((f"e{name:02}", "be", *a, *b))
    g = G.graph_edges(spark.createDataFrame(rows, EDGE))
    ch = G.chains(g)
    for x in (0.0, 23.0):
        begin = ch.select("chain").distinct().withColumn("v", G.vertex_key(F.lit(x), F.lit(0.0)))
        got = {r.eid: r.pos for r in G.chain_positions(g, ch, begin).collect()}
        assert got == {f"e{name:02}": place if not x else 22 - place for place, name in enumerate(order)}


def test_first_part_from_the_base(spark):
    rows = [(1, 0, 10.0, 1.0), (1, 1, 20.0, 0.5), (1, 2, 40.0, 1.0), (2, 0, 7.0, 0.0), (3, 0, 5.0, 1.0)]
    got = {r.chain: r.length for r in C.first_part_length(spark.createDataFrame(rows, "chain int, pos int, len double, ratio double")).collect()}
    assert got == {1: 20.0, 2: 0.0, 3: 5.0}


def test_every_crossing_is_a_point(spark):
    edges = spark.createDataFrame([("e", "be", "road", 0.0, 0.0, 100.0, 0.0)], "objectid string, country string, form_of_way string, x0 double, y0 double, x1 double, y1 double")
    border = spark.createDataFrame([(f"b{k}", 10.0 + 30 * k, -5.0 if k % 2 == 0 else 5.0, 40.0 + 30 * k, 5.0 if k % 2 == 0 else -5.0) for k in range(3)], "objectid string, x0 double, y0 double, x1 double, y1 double")
    cls = spark.createDataFrame([("c", 27.0, -1.0, 27.0, 1.0)], border.schema)
    got = sorted((r.id, r.x) for r in M.crossing_points(edges, border, cls, TN).collect())
    assert [(i, round(x, 9)) for i, x in got] == [("Xe", 27.0), ("Xe+2", 55.0), ("Xe+3", 85.0)]


def test_a_free_end_meets_an_inner_one(spark):
    rows = [("a", 0.0, 0.0, 10.0, 0.0), ("b", 11.0, 0.0, 20.0, 0.0), ("c", 11.0, 0.0, 11.0, 9.0)]
    got = {r.objectid: (r.x0, r.x1) for r in M.snap_lines(spark.createDataFrame(rows, "objectid string, x0 double, y0 double, x1 double, y1 double"), TN).collect()}
    assert got == {"a": (0.0, 10.5), "b": (10.5, 20.0), "c": (10.5, 11.0)}
