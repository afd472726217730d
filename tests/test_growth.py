"""Work that must grow with the tables alone: cases of the findings in FINDINGS_r03.md."""

import random

import pytest
from pyspark.sql import functions as F

from borderloom.operators import cleaning as C
from borderloom.operators import coverage, graph, matching, spatial
from borderloom.plans.params import Params
from borderloom.sources.staging import cut

from .test_network import areas, edges

FAR = 1e12


def points(spark, *ps):
    return spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(ps)], "id int, x double, y double")


def test_cells_follow_the_size_of_a_polygon(spark):
    """A rectangle of 10^12 m had 2 * 10^10 cells of 50 m."""
    land = areas(spark, ("be", (0, 0, 100, FAR)), ("fr", (0, -FAR, 100, 0)), ("be", (10, 10, 20, 20)))
    got = {(r.p_id, r.poly_id) for r in spatial.points_in(points(spark, (15, 15), (50, 1e9), (50, -60), (150, 5)), land).collect()}
    assert got == {(0, "0"), (0, "2"), (1, "0"), (2, "1")}
    e = edges(spark, ("a", 50, -10, 50, 30), ("b", 90, 5, 130, 5), ("c", 50, -10, 50, 30, "fr"), ("d", 300, 0, 310, 0))
    assert {r.objectid: round(r.ratio, 9) for r in C.in_country_ratio(e, land).collect()} == {"a": 0.75, "b": 0.25, "c": 0.25, "d": 0}
    near = {r.objectid: round(r.ratio, 9) for r in C.buffered_ratio(e, land, 20.0).collect()}
    assert near["a"] == 1 and near["d"] == 0 and 0.5 <= near["b"] < 0.8


@pytest.mark.parametrize("seed", range(3))
def test_sized_grids_find_every_pair_once(spark, seed):
    rng = random.Random(seed)
    a = [(k, *(v := [rng.uniform(-900, 900), rng.uniform(-900, 900)]), v[0] + rng.uniform(0, 70), v[1] + rng.uniform(0, 70)) for k in range(150)]
    b = [(k, *(v := [rng.uniform(-900, 900), rng.uniform(-900, 900)]), v[0] + 10 ** rng.uniform(-1, 3.3), v[1] + 10 ** rng.uniform(-1, 3.3)) for k in range(60)]
    cols = "double, ".join(("xmin ", "ymin ", "xmax ", "ymax ")) + "double"
    one, two = spark.createDataFrame(a, f"a long, {cols}"), spark.createDataFrame(b, f"b long, {cols}")
    want = sorted((p[0], q[0]) for p in a for q in b if q[1] <= p[3] + 3 and q[3] >= p[1] - 3 and q[2] <= p[4] + 3 and q[4] >= p[2] - 3)
    assert sorted((r.a, r.b) for r in spatial.box_join(one, two, 3.0, 20.0, sized=True).collect()) == want and want


def test_a_polygon_with_a_hole(spark):
    ring = "poly_id string, country string, ring array<struct<x:double,y:double,z:double>>"
    square = lambda a, b: [(float(x), float(y), 0.0) for x, y in ((a, a), (b, a), (b, b), (a, b), (a, a))]
    land = spark.createDataFrame([("p", "be", square(0, 100)), ("p", "be", square(40, 60))], ring)
    assert {r.p_id for r in spatial.points_in(points(spark, (10, 10), (50, 50), (70, 50)), land).collect()} == {0, 2}
    e = edges(spark, ("a", 0, 50, 100, 50)).withColumn("pos", F.lit(0))
    assert round(coverage.covered_ratio(e, land).first().ratio, 9) == 0.8


@pytest.fixture
def many_partitions(spark):
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def roots(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize("near", [True, False])
def test_components_over_several_blocks(spark, many_partitions, near):
    """Paths, rings and a lone loop, in order of their places and not: nodes that are in several blocks join them."""
    rng = random.Random(5)
    links = [(f"n{k}", f"n{k + 1}") for k in range(200) if k % 67] + [("n0", "n66"), ("z", "z")]
    rows = [(a, b, float(k) if near else rng.random()) for k, (a, b) in enumerate(links)]
    got = graph.components(spark.createDataFrame(rows, "a string, b string, x double"), "a", "b", "x").collect()
    assert {r.node: r.root for r in got} == roots(links) and len(got) == len(roots(links))


def test_faces_of_many_components_at_once(spark):
    """Squares with a diagonal and a tail each: the faces of one are those of all, in the order they had in a task of their own."""
    es = [(f"{k}{n}", 100 * k + a, b, 100 * k + c, d) for k in range(30) for n, (a, b, c, d) in enumerate([(0, 0, 10, 0), (10, 0, 10, 10), (10, 10, 0, 10), (0, 10, 0, 0), (0, 0, 10, 10), (10, 10, 15, 15)])]
    f = graph.faces(graph.graph_edges(edges(spark, *es))).toPandas()
    assert len(f) == 2 * len(es) and f.groupby("face_id").area.first().round(6).value_counts().to_dict() == {50.0: 60, -100.0: 30}
    for _, ring in f.sort_values("ord").groupby("face_id"):
        assert list(ring.ord) == list(range(len(ring))) and list(ring.w) == list(ring.v[1:]) + list(ring.v[:1])
    assert f.groupby("root").face_id.agg(lambda s: sorted({i.split("/")[1] for i in s})).map(tuple).unique().tolist() == [("0", "1", "2")]


def test_faces_run_no_python_for_each_component(spark):
    plan = graph.faces(graph.graph_edges(edges(spark, (1, 0, 0, 10, 0), (2, 10, 0, 10, 10))))._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan and "FlatMapGroupsInArrow" not in plan


def test_estimates_do_not_grow_with_the_rounds_of_a_loop(spark):
    df = spark.range(10)
    for _ in range(5):
        df = cut(df.join(df.withColumnRenamed("id", "other"), F.col("id") == F.col("other")).select("id"))
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**64 and df.count() == 10


def test_lines_are_read_once_to_be_merged(spark, tmp_path):
    log = str(tmp_path / "read")

    def seen(batches):
        with open(log, "a") as f:
            f.write("x")
        yield from batches

    e = edges(spark, (1, 0, 3, 100, 3, "be"), (2, 20, -3, 120, -3, "fr"))
    border = spark.createDataFrame([("B", -50.0, 0.0, 200.0, 0.0)], "objectid string, x0 double, y0 double, x1 double, y1 double")
    single = matching.lines_by_country(e, border, Params()).coalesce(1)
    got = matching.merge_lines(single.mapInArrow(seen, single.schema), e, Params()).collect()
    assert [r.linked_feat_id for r in got] == ["1#2"] and open(log).read() == "x"


def test_points_near_the_border_meet_few_of_its_pieces(spark, monkeypatch):
    found = []
    near = matching.points_near_segments

    def counted(*a, **k):
        found.append(near(*a, **k).count())
        return near(*a, **k)

    monkeypatch.setattr(matching, "points_near_segments", counted)
    border = spark.createDataFrame([(f"B{k}", 100.0 * k, 0.0, 100.0 * k + 100, 0.0) for k in range(40)], "objectid string, x0 double, y0 double, x1 double, y1 double")
    groups = spark.createDataFrame([(f"g{k}", "e", "be", 100.0 * k + 50, 1.0 if k else 500.0) for k in range(40)] + [("far", "e", "be", 50.0, 2000.0)], "`group` string, edge string, country string, x double, y double")
    got = {r.objectid.removeprefix("CONNECTINGPOINT"): (r.x, r.y) for r in matching.connecting_points(groups, border).collect()}
    assert got == {f"g{k}": (100.0 * k + 50, 0.0) for k in range(40)} and sum(found) < 100


def test_narrow_faces_are_walked_once(spark):
    e = edges(spark, (1, 0, 0, 100, 0), (2, 0, 0, 50, -2), (3, 50, -2, 100, 0), (4, 0, 0, 0, 90), (5, 0, 90, 100, 0))
    f = C.slim_faces(e, 10.0, Params())
    assert "MapInArrow" not in f._jdf.queryExecution().toString()
    assert {r.eid for r in f.collect()} == {"1", "2", "3"}
