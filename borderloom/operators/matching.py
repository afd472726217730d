"""Steps that match the two networks: fictitious flags, junctions, connecting points and lines.

Each step takes tables and returns tables.  Where several candidates are equally
good, the smaller id is taken, so results don't depend on the order of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from borderloom.functions.geometry import along, angle, distance, point_segment, project_t
from borderloom.operators.coverage import covered_ratio
from borderloom.operators.graph import graph_edges, graph_vertices, half_edges, planarize, vertex_key
from borderloom.operators.spatial import best, box_join, boxed, crossings, mutual_best, points_near, points_near_segments, segments_near
from borderloom.operators.tables import update
from borderloom.plans.params import Params
from borderloom.sources.staging import cut


# 201


def fill_fictitious(edges: DataFrame, areas: DataFrame, p: Params) -> DataFrame:
    """Edges with fictitious set by the share of their length inside areas, and w_tag where it changed."""
    segs = edges.select("objectid", "country", "x0", "y0", "x1", "y1").withColumn("pos", F.lit(0))
    e = edges.join(covered_ratio(segs, areas).select("objectid", "ratio"), "objectid")
    inside = F.round("ratio", 9) >= p.fff_ratio
    e = e.withColumn("w_tag", F.when(inside & (F.col("fictitious") == "false"), "debug_201_to_true").when(~inside & (F.col("fictitious") == "true"), "debug_201_to_false"))
    return e.withColumn("fictitious", F.when(F.col("w_tag") == "debug_201_to_true", "true").when(F.col("w_tag") == "debug_201_to_false", "false").otherwise(F.col("fictitious")))


# 202


def junctions(edges: DataFrame, country: str) -> DataFrame:
    """Vertices (id, x, y, degree, fictitious) of a country's edges where three or more meet."""
    h = half_edges(graph_edges(edges.where(F.col("country") == country)), keep=("fictitious",))
    return graph_vertices(h, [F.bool_or(F.col("fictitious") == "true").alias("fictitious")]).where("degree >= 3").withColumnRenamed("v", "id")


def match_junctions(edges: DataFrame, p: Params) -> DataFrame:
    """Mutually nearest junctions (a_id, b_id, x, y) of equal degree in the two countries, and where both go.

    Where one alone has a fictitious edge the other moves onto it, otherwise both
    to the middle.
    """
    one, two = p.pair.split("#")
    a, b = junctions(edges, one), junctions(edges, two)
    pairs = points_near(a, b, p.dist_max_junctions)
    qa = a.select(F.col("id").alias("a_id"), F.col("degree").alias("da"), F.col("fictitious").alias("fa"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    qb = b.select(F.col("id").alias("b_id"), F.col("degree").alias("db"), F.col("fictitious").alias("fb"), F.col("x").alias("bx"), F.col("y").alias("by"))
    m = mutual_best(pairs.join(qa, "a_id").join(qb, "b_id").where("da = db"))
    to = lambda u, v: F.when(F.col("fa") & ~F.col("fb"), F.col(u)).when(F.col("fb") & ~F.col("fa"), F.col(v)).otherwise((F.col(u) + F.col(v)) / 2)
    return m.select("a_id", "b_id", to("ax", "bx").alias("x"), to("ay", "by").alias("y"))


def move_junctions(edges: DataFrame, matches: DataFrame, p: Params) -> DataFrame:
    """Edges with the ends at matched junctions moved to their targets."""
    one, two = p.pair.split("#")
    moves = matches.select(F.lit(one).alias("country"), F.col("a_id").alias("v"), "x", "y").union(matches.select(F.lit(two), "b_id", "x", "y"))
    g = graph_edges(edges)
    for end, (x, y) in (("v0", ("x0", "y0")), ("v1", ("x1", "y1"))):
        m = moves.select("country", F.col("v").alias(end), F.col("x").alias("_x"), F.col("y").alias("_y"))
        g = g.join(m, ["country", end], "left").withColumns({x: F.coalesce("_x", x), y: F.coalesce("_y", y)}).drop("_x", "_y")
    return g.select(edges.columns)


# 240


def crossing_points(edges: DataFrame, border: DataFrame, cls: DataFrame, p: Params) -> DataFrame:
    """Connecting points (id, edge, country, way, x, y) where edges meet the border, each moved to the nearest crossing of its edge with a connecting line within its distance.

    An edge has a point for each of its distinct crossings, numbered along it;
    crossings that move to the same place are one point.
    """
    e = edges.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1")
    at = crossings(e, border.withColumnRenamed("objectid", "id")).select(F.col("a_id").alias("edge"), F.round("t", 9).alias("t"), "x", "y")
    at = cut(at.groupBy("edge", "t").agg(F.min(F.struct("x", "y")).alias("h")).select("edge", "t", "h.x", "h.y"))
    cl = crossings(e, cls.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1")).select(F.col("a_id").alias("edge"), F.col("b_id").alias("cl"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    near = at.join(cl, "edge").withColumn("dist", distance("x", "y", "cx", "cy")).where(F.col("dist") <= p.cp_intersected_cl_dist)
    w = Window.partitionBy("edge", "t").orderBy(F.round("dist", 9), "cl", "cx", "cy")
    near = near.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("edge", "t", "cx", "cy")
    to = at.join(near, ["edge", "t"], "left").select("edge", "t", F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y"))
    to = to.groupBy("edge", F.round("x", 6).alias("_x"), F.round("y", 6).alias("_y")).agg(F.min(F.struct("t", "x", "y")).alias("h")).select("edge", "h.*")
    k = F.row_number().over(Window.partitionBy("edge").orderBy("t"))
    attrs = edges.select(F.col("objectid").alias("edge"), "country", F.col("form_of_way").alias("way"))
    named = to.withColumn("k", k).join(attrs, "edge")
    return named.select(F.concat(F.lit("X"), "edge", F.when(F.col("k") > 1, F.concat(F.lit("+"), "k")).otherwise(F.lit(""))).alias("id"), "edge", "country", "way", "x", "y")


def undershoots(edges: DataFrame, border: DataFrame, p: Params) -> DataFrame:
    """Connecting points (id, edge, country, way, x, y) of dangling edges that end before the border.

    The last segment is extended to the border; the nearest point of the border
    is taken instead where it is nearer than a third of that.
    """
    most = p.cp_undershoot_dist
    b = border.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1")
    met = crossings(edges.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1"), b).select(F.col("a_id").alias("eid")).distinct()
    h = half_edges(graph_edges(edges)).where("len > 0")
    tips = graph_vertices(h).where("degree = 1").select("v")
    d = h.join(tips, "v").join(met, "eid", "left_anti").select("eid", "v", "x", "y", ((F.col("x") - F.col("xw")) / F.col("len")).alias("dx"), ((F.col("y") - F.col("yw")) / F.col("len")).alias("dy"))
    d = cut(d)  # else the divisions would be written out again in every formula
    ray = cut(d.select(F.struct("eid", "v").alias("id"), F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("dx") * most).alias("x1"), (F.col("y") + F.col("dy") * most).alias("y1")))
    axial = crossings(ray, b).groupBy("a_id").agg(F.min(F.struct((F.col("t") * most).alias("dist"), "x", "y")).alias("h")).select(F.col("a_id").alias("id"), F.col("h.dist").alias("ad"), F.col("h.x").alias("ax"), F.col("h.y").alias("ay"))
    near = best(points_near_segments(ray.select("id", F.col("x0").alias("x"), F.col("y0").alias("y")), b, most), "p_id", "s_id")
    seg = b.select(F.col("id").alias("s_id"), *[F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")])
    ortho = near.join(seg, "s_id").join(d.select(F.struct("eid", "v").alias("p_id"), "x", "y"), "p_id").withColumn("t", project_t("x", "y", "bx0", "by0", "bx1", "by1"))
    ortho = cut(ortho).select(F.col("p_id").alias("id"), F.col("dist").alias("od"), along("bx0", "bx1", "t").alias("ox"), along("by0", "by1", "t").alias("oy"))
    both = cut(axial.join(ortho, "id", "full"))
    use = F.col("ad").isNull() | (F.col("od") < F.col("ad") / 3)
    to = both.select(F.col("id.eid").alias("edge"), F.when(use, F.col("ox")).otherwise(F.col("ax")).alias("x"), F.when(use, F.col("oy")).otherwise(F.col("ay")).alias("y"), F.col("id.v").alias("v"))
    attrs = edges.select(F.col("objectid").alias("edge"), "country", F.col("form_of_way").alias("way"))
    return to.join(attrs, "edge").select(F.concat(F.lit("U"), "edge", F.lit("@"), "v").alias("id"), "edge", "country", "way", "x", "y")


def pair_points(points: DataFrame, p: Params) -> DataFrame:
    """Groups (group, id, edge, country, way, x, y) of points of both countries.

    Points of opposite countries are partners up to a distance that is larger
    where both ways are tracks or paths.  Mutually nearest ones begin a group;
    any other joins the group of its nearest partner, or begins one with it.
    Points without a partner go.
    """
    one, two = p.pair.split("#")
    points = cut(points)
    track = lambda c: F.col(c).isin("tractor_road", "walkway")
    way = points.select("id", "way")
    pairs = points_near(points.where(F.col("country") == one), points.where(F.col("country") == two), max(p.cp_merge_dist, p.cp_merge_dist_tractor))
    pairs = pairs.join(way.select(F.col("id").alias("a_id"), F.col("way").alias("wa")), "a_id").join(way.select(F.col("id").alias("b_id"), F.col("way").alias("wb")), "b_id")
    pairs = cut(pairs.where(F.col("dist") < F.when(track("wa") & track("wb"), p.cp_merge_dist_tractor).otherwise(p.cp_merge_dist)))
    mutual = mutual_best(pairs).select("a_id", "b_id")
    began = mutual.select(F.col("a_id").alias("id"), F.col("a_id").alias("group")).union(mutual.select(F.col("b_id"), F.col("a_id")))
    sides = pairs.select(F.col("a_id").alias("id"), F.col("b_id").alias("other"), "dist").union(pairs.select("b_id", "a_id", "dist"))
    rest = best(sides, "id", "other").join(began, "id", "left_anti").select("id", "other")
    joins = rest.join(began.select(F.col("id").alias("other"), F.col("group").alias("g")), "other", "left").select("id", "other", F.coalesce("g", "other").alias("group"), F.col("g").isNull().alias("fresh"))
    claimed = joins.where("fresh").select(F.col("other").alias("id"), F.col("other").alias("group"))
    every = began.union(joins.select("id", "group")).union(claimed)
    # a point that claims and is claimed stays with the smaller group
    member = every.groupBy("id").agg(F.min("group").alias("group"))
    return points.join(member, "id").select("group", *points.columns)


def connecting_points(groups: DataFrame, border: DataFrame) -> DataFrame:
    """One point (objectid, linked_feat_id, n, x, y) a group: its centroid on the nearest border."""
    c = cut(groups.groupBy("group").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n"), F.concat_ws("#", F.transform(F.array_sort(F.collect_set(F.struct("country", "edge"))), lambda s: s["edge"])).alias("linked_feat_id")))
    b = border.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1")
    at = c.select(F.col("group").alias("id"), "x", "y")
    find = lambda pts, most: best(points_near_segments(pts, b, most, 200.0), "p_id", "s_id").select(F.col("p_id").alias("group"), F.col("s_id").alias("id"))
    # most points lie near a border: only the others are held against all pieces far around
    close = cut(find(at, 50.0))
    near = close.union(find(at.join(close.select(F.col("group").alias("id")), "id", "left_anti"), 1000.0))
    j = cut(c.join(near, "group").join(b, "id").withColumn("t", project_t("x", "y", "x0", "y0", "x1", "y1")))
    return j.select(F.concat(F.lit("CONNECTINGPOINT"), "group").alias("objectid"), "linked_feat_id", "n", along("x0", "x1", "t").alias("x"), along("y0", "y1", "t").alias("y"))


def snap_points_to_lines(points: DataFrame, cls: DataFrame, p: Params) -> DataFrame:
    """Points (objectid, cl, t, x, y) moved to the nearest connecting line within the snap distance; t is where to cut it."""
    c = cls.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1")
    points = cut(points)
    near = best(points_near_segments(points.select(F.col("objectid").alias("id"), "x", "y"), c, p.cp_2_cl_snap), "p_id", "s_id")
    j = points.select("objectid", F.col("x").alias("px"), F.col("y").alias("py")).join(near.select(F.col("p_id").alias("objectid"), F.col("s_id").alias("id")), "objectid", "left").join(c, "id", "left")
    j = cut(j.withColumn("t", F.when(F.col("id").isNotNull(), project_t("px", "py", "x0", "y0", "x1", "y1"))))
    return j.select("objectid", F.col("id").alias("cl"), "t", F.coalesce(along("x0", "x1", "t"), "px").alias("x"), F.coalesce(along("y0", "y1", "t"), "py").alias("y"))


# 250, 220


def connect_points(edges: DataFrame, points: DataFrame, p: Params) -> DataFrame:
    """What connecting points (objectid, edge, x, y) do to their edges: (objectid, edge, kind, s, dx, dy).

    Near an end the end is snapped, otherwise the edge is cut at the projection;
    (dx, dy) leads from there to the point.
    """
    j = points.select(F.col("objectid").alias("cp"), "edge", F.col("x").alias("px"), F.col("y").alias("py")).join(edges.withColumnRenamed("objectid", "edge"), "edge")
    j = cut(j.withColumns({"t": project_t("px", "py", "x0", "y0", "x1", "y1"), "len": distance("x0", "y0", "x1", "y1")}))
    d0, d1 = F.col("t") * F.col("len"), (1 - F.col("t")) * F.col("len")
    kind = F.when((d0 < p.snap_dist) & (d0 <= d1), "start").when(d1 < p.snap_dist, "end").otherwise("cut")
    t = F.when(F.col("kind") == "start", 0.0).when(F.col("kind") == "end", 1.0).otherwise(F.col("t"))
    j = cut(j.withColumn("kind", kind)).withColumn("t", t)
    return j.select(F.col("cp").alias("objectid"), "edge", "kind", (F.col("t") * F.col("len")).alias("s"), (F.col("px") - along("x0", "x1", "t")).alias("dx"), (F.col("py") - along("y0", "y1", "t")).alias("dy"))


def mean_displacements(moves: DataFrame) -> DataFrame:
    """Mean vector (v, dx, dy) of displacements (x, y, dx, dy) that start at one vertex."""
    return moves.groupBy(vertex_key("x", "y").alias("v")).agg(F.avg("dx").alias("dx"), F.avg("dy").alias("dy"))


def connect_lines(edges: DataFrame, cls: DataFrame, p: Params) -> DataFrame:
    """Where connecting lines replace parts of their edges: (objectid, edge, s_from, s_to, dx0, dy0, dx1, dy1).

    The line's ends are matched to the edge so that the nearest of the four
    distances of ends is kept; projections near an end of the edge snap to it.
    """
    link = cls.select("objectid", F.explode(F.split("linked_feat_id", "#")).alias("edge"), *[F.col(c).alias(f"c{c}") for c in ("x0", "y0", "x1", "y1")])
    j = link.join(edges.select(F.col("objectid").alias("edge"), "x0", "y0", "x1", "y1"), "edge").withColumn("len", distance("x0", "y0", "x1", "y1"))
    d = lambda a, b: distance(f"c{a[0]}", f"c{a[1]}", b[0], b[1])
    s, e = ("x0", "y0"), ("x1", "y1")
    straight = F.least(d(s, s), d(e, e)) <= F.least(d(s, e), d(e, s))
    for k, c in enumerate("01"):
        o = "10"[k]
        j = j.withColumns({f"px{c}": F.when(straight, F.col(f"cx{c}")).otherwise(F.col(f"cx{o}")), f"py{c}": F.when(straight, F.col(f"cy{c}")).otherwise(F.col(f"cy{o}"))})
    for c in "01":
        t = project_t(f"px{c}", f"py{c}", "x0", "y0", "x1", "y1")
        j = j.withColumn(f"t{c}", F.when(t * F.col("len") < p.snap_dist, 0.0).when((1 - t) * F.col("len") < p.snap_dist, 1.0).otherwise(t))
    return j.select("objectid", "edge", (F.col("t0") * F.col("len")).alias("s_from"), (F.col("t1") * F.col("len")).alias("s_to"), *[(F.col(f"p{a}{c}") - along(f"{a}0", f"{a}1", f"t{c}")).alias(f"d{a}{c}") for c in "01" for a in "xy"])


def without_parts(edges: DataFrame, parts: DataFrame, precision: float = 1e-5) -> DataFrame:
    """Edges without the parts (edge, s_from, s_to) that lines replace.

    Parts of one edge are merged where they overlap; what is left between them, and
    before the first and behind the last, are edges of their own, numbered behind
    the edge's id.  Edges without a part stay as they are.
    """
    lo, hi = F.least("s_from", "s_to"), F.greatest("s_from", "s_to")
    gone = parts.select(F.col("edge").alias("objectid"), lo.alias("lo"), hi.alias("hi"))
    sized = edges.withColumn("_len", distance("x0", "y0", "x1", "y1"))
    hit = gone.select("objectid").distinct()
    # a mark without length at the edge's end closes the last gap
    marks = gone.union(sized.join(hit, "objectid", "left_semi").select("objectid", F.col("_len").alias("lo"), F.col("_len").alias("hi")))
    w = Window.partitionBy("objectid").orderBy("lo", "hi")
    reach = F.coalesce(F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    gaps = marks.select("objectid", reach.alias("_a"), F.col("lo").alias("_b")).where(F.col("_b") - F.col("_a") > precision)
    gaps = gaps.withColumn("_k", F.row_number().over(Window.partitionBy("objectid").orderBy("_a")))
    j = sized.join(gaps, "objectid")
    at = lambda c, s: F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * F.col(s) / F.col("_len")
    new = {"objectid": F.concat_ws("/", "objectid", "_k"), "x0": at("x", "_a"), "y0": at("y", "_a"), "x1": at("x", "_b"), "y1": at("y", "_b")}
    left = j.select(*[new[c].alias(c) if c in new else F.col(c) for c in edges.columns])
    return edges.join(hit, "objectid", "left_anti").select(edges.columns).union(left)


def cut_at_points(edges: DataFrame, found: DataFrame) -> DataFrame:
    """Edges snapped to and cut at connecting points (objectid, edge, kind, s, x, y) of :func:`connect_points`.

    An end takes the place of the point that snaps it (the smallest id of several);
    at every other point the edge is cut, and both pieces end there.  Pieces are
    numbered behind the edge's id; an edge without a cut keeps its id.
    """
    key = found.select(F.col("edge").alias("objectid"), F.col("objectid").alias("cp"), "kind", "s", F.col("x").alias("px"), F.col("y").alias("py"))
    end = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct("cp", "px", "py")))
    tips = key.groupBy("objectid").agg(end("start").alias("_a"), end("end").alias("_b"), F.array_sort(F.collect_set(F.when(F.col("kind") == "cut", F.struct("s", "px", "py")))).alias("_cuts"))
    e = edges.join(tips, "objectid")
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    first = pt(F.coalesce("_a.px", "x0"), F.coalesce("_a.py", "y0"))
    last = pt(F.coalesce("_b.px", "x1"), F.coalesce("_b.py", "y1"))
    inner = F.transform("_cuts", lambda c: F.struct(c["px"].alias("x"), c["py"].alias("y")))
    e = e.withColumn("_v", F.concat(F.array(first), inner, F.array(last))).select("*", F.posexplode(F.arrays_zip(F.slice("_v", 1, F.size("_v") - 1).alias("a"), F.slice("_v", 2, F.size("_v") - 1).alias("b"))).alias("_k", "_e"))
    name = F.when(F.size("_cuts") == 0, F.col("objectid")).otherwise(F.concat_ws("/", "objectid", F.col("_k") + 1))
    new = {"objectid": name, "x0": F.col("_e.a.x"), "y0": F.col("_e.a.y"), "x1": F.col("_e.b.x"), "y1": F.col("_e.b.y")}
    cut_up = e.select(*[new[c].alias(c) if c in new else F.col(c) for c in edges.columns])
    return edges.join(tips.select("objectid"), "objectid", "left_anti").select(edges.columns).union(cut_up)


# 210 to 214


def lines_by_country(edges: DataFrame, border: DataFrame, p: Params) -> DataFrame:
    """Connecting lines (objectid, country, linked_feat_id, x0, y0, x1, y1) of single-country edges that run along the border.

    The part of an edge inside a flat-ended band round a border piece is an
    interval of its parameter.  An edge wholly inside must also run within the
    largest angle of the border; one partly inside counts where its first run of
    parts, with gaps up to a threshold, is mostly inside.  The line is the
    border between the projections of the first part's ends.
    """
    band = p.cl_buffer_dist
    e = boxed(edges.where(~F.col("country").contains("#")).select("objectid", "country", "x0", "y0", "x1", "y1"), "segment")
    b = boxed(border.select(F.col("objectid").alias("piece"), "x0", "y0", "x1", "y1"), "segment").select("piece", F.col("x0").alias("u0"), F.col("y0").alias("v0"), F.col("x1").alias("u1"), F.col("y1").alias("v1"), "xmin", "xmax", "ymin", "ymax")
    j = box_join(e, b, band, 100.0)
    bx, by = F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")
    n = F.sqrt(bx * bx + by * by)
    j = j.withColumns({"blen": n, "ex": bx / n, "ey": by / n, "len": distance("x0", "y0", "x1", "y1")}).where("len > 0 and blen > 0")
    a = lambda x, y: (F.col(x) - F.col("u0")) * F.col("ex") + (F.col(y) - F.col("v0")) * F.col("ey")  # noqa: E731  along the border
    o = lambda x, y: (F.col(y) - F.col("v0")) * F.col("ex") - (F.col(x) - F.col("u0")) * F.col("ey")  # noqa: E731  off it
    j = j.withColumns({"a0": a("x0", "y0"), "a1": a("x1", "y1"), "o0": o("x0", "y0"), "o1": o("x1", "y1")})

    def limits(f0: str, f1: str, lo, hi):
        d = F.col(f1) - F.col(f0)
        inside = F.when((F.col(f0) >= lo) & (F.col(f0) <= hi), F.lit(0.0)).otherwise(F.lit(2.0))
        first = F.when(d > 0, (lo - F.col(f0)) / d).when(d < 0, (hi - F.col(f0)) / d).otherwise(inside)
        last = F.when(d > 0, (hi - F.col(f0)) / d).when(d < 0, (lo - F.col(f0)) / d).otherwise(F.lit(1.0))
        return first, last

    f1, l1 = limits("a0", "a1", F.lit(0.0), F.col("blen"))
    f2, l2 = limits("o0", "o1", F.lit(-band), F.lit(band))
    j = j.withColumns({"t0": F.greatest(F.lit(0.0), f1, f2), "t1": F.least(F.lit(1.0), l1, l2)}).where("t0 < t1")
    w = Window.partitionBy("objectid").orderBy("t0", "t1", "piece")
    reach = F.max("t1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    j = j.withColumn("gap", (F.col("t0") - reach) * F.col("len")).withColumn("run", F.sum(F.when(F.col("gap") > p.cl_threshold_no_cl, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    turn = angle(F.expr("x1 - x0"), F.expr("y1 - y0"), F.col("ex"), F.col("ey"))
    first = F.struct("t0", "t1", "piece")
    run = j.where("run = 0").groupBy("objectid", "country", "len", "x0", "y0", "x1", "y1").agg(
        F.min("t0").alias("lo"), F.max("t1").alias("hi"), F.sum(F.col("t1") - F.col("t0")).alias("inside"),
        F.min_by(F.struct("u0", "v0", "u1", "v1", "t0", "t1", turn.alias("turn")), first).alias("f"),
    )
    whole = (F.col("lo") <= 0) & (F.col("hi") >= 1)
    most = math.radians(p.cl_border_max_angle)
    good = F.when(whole, (F.col("f.turn") < most) | (F.col("f.turn") > math.pi - most)).otherwise(F.col("inside") > p.cl_ratio_in_buffer * (F.col("hi") - F.col("lo")))
    k = run.where(good).select("objectid", "country", "x0", "y0", "x1", "y1", "f.*")
    for end in "01":
        k = k.withColumns({f"px{end}": along("x0", "x1", f"t{end}"), f"py{end}": along("y0", "y1", f"t{end}")}).withColumn(f"s{end}", project_t(f"px{end}", f"py{end}", "u0", "v0", "u1", "v1"))
    out = k.select(
        F.concat(F.lit("CONNECTINGLINE"), "objectid").alias("objectid"), "country", F.col("objectid").alias("linked_feat_id"),
        along("u0", "u1", "s0").alias("x0"), along("v0", "v1", "s0").alias("y0"), along("u0", "u1", "s1").alias("x1"), along("v0", "v1", "s1").alias("y1"),
    )
    return out.where("x0 <> x1 or y0 <> y1")


def greedy_pairs(candidates: DataFrame, group: str = "part") -> DataFrame:
    """A matching (part, a_id, b_id, dist) within each group, nearest pairs first: rounds of mutual best, none used twice."""
    left = cut(candidates.select(group, "a_id", "b_id", "dist"))
    taken = None
    while True:
        keyed = left.withColumns({"_a": F.struct(group, "a_id"), "_b": F.struct(group, "b_id")})
        new = cut(mutual_best(keyed, "_a", "_b").select(group, "a_id", "b_id", "dist"))
        taken = new if taken is None else taken.union(new)
        left = cut(left.join(new.select(group, "a_id"), [group, "a_id"], "left_anti").join(new.select(group, "b_id"), [group, "b_id"], "left_anti"))
        if not left.limit(1).count():
            return taken


def merge_lines(cls: DataFrame, edges: DataFrame, p: Params) -> DataFrame:
    """Connecting lines of the pair (objectid, country, linked_feat_id, x0, y0, x1, y1) from overlapping lines of single countries.

    Lines are noded; a part that has lines of both countries takes the nearest
    edges of them within the largest distance.
    """
    one, two = p.pair.split("#")
    cls = cut(cls)  # read for the noding, and for the lines of each country
    parts = planarize(cls.select(F.col("objectid").alias("id"), "x0", "y0", "x1", "y1"), 1e4)
    parts = cut(parts.withColumn("part", F.concat_ws("|", "v0", "v1")).select("part", "x0", "y0", "x1", "y1", "origins"))
    who = parts.select("part", F.explode("origins").alias("objectid")).join(cls.select("objectid", "country", "linked_feat_id"), "objectid")
    seg = edges.select(F.col("objectid").alias("linked_feat_id"), "x0", "y0", "x1", "y1")
    side = lambda c, n: who.where(F.col("country") == c).join(seg, "linked_feat_id").select("part", F.col("linked_feat_id").alias(f"{n}_id"), *[F.col(k).alias(f"{n}{k}") for k in ("x0", "y0", "x1", "y1")])
    ab = side(one, "a").join(side(two, "b"), "part")
    # Hausdorff distance of the parts of both edges between the projections of the line's ends
    ab = ab.join(parts.select("part", "x0", "y0", "x1", "y1"), "part")
    for n in "ab":
        ab = ab.withColumns({f"{n}t{e}": project_t(f"x{e}", f"y{e}", f"{n}x0", f"{n}y0", f"{n}x1", f"{n}y1") for e in "01"})
    ab = cut(ab)  # else the projections would be written out again wherever they are used
    ab = cut(ab.withColumns({f"{n}{c}{e}p": along(f"{n}{c}0", f"{n}{c}1", f"{n}t{e}") for n in "ab" for e in "01" for c in "xy"}))
    off = lambda n, m, e: point_segment(f"{n}x{e}p", f"{n}y{e}p", f"{m}x0p", f"{m}y0p", f"{m}x1p", f"{m}y1p")
    ab = ab.withColumn("dist", F.greatest(off("a", "b", 0), off("a", "b", 1), off("b", "a", 0), off("b", "a", 1)))
    pairs = greedy_pairs(ab.where(F.col("dist") <= p.cl_edge_max_dist))
    return parts.join(pairs, "part").select(F.concat(F.lit("CONNECTINGLINE"), "part", F.lit("/"), "a_id").alias("objectid"), F.lit(p.pair).alias("country"), F.concat_ws("#", "a_id", "b_id").alias("linked_feat_id"), "x0", "y0", "x1", "y1")


def snap_lines(cls: DataFrame, p: Params) -> DataFrame:
    """Connecting lines whose free ends move to the middle between them and the nearest end of another line, which moves there too.

    A free end is a vertex of degree 1; the other line's end may have any degree.
    Ends apart by more than nothing and at most the largest distance that are
    each other's nearest move, a vertex once.
    """
    g = graph_edges(cls, 0.01)
    ends = cut(graph_vertices(half_edges(g)).select(F.col("v").alias("id"), "x", "y", "degree"))
    owner = half_edges(g).select(F.col("v").alias("id"), "eid")
    near = points_near(ends.where("degree = 1"), ends, p.cl_cl_closest_max_dist + 1e-9).where("a_id <> b_id and dist > 0")
    same = owner.select(F.col("id").alias("a_id"), "eid").join(owner.select(F.col("id").alias("b_id"), "eid"), "eid").select("a_id", "b_id")
    near = near.join(same, ["a_id", "b_id"], "left_anti")
    both = near.union(near.select(F.col("b_id"), F.col("a_id"), "dist")).distinct()
    pairs = mutual_best(both).select("a_id", "b_id")
    at = ends.select(F.col("id").alias("b_id"), F.col("x").alias("bx"), F.col("y").alias("by"))
    to = pairs.join(ends.withColumnRenamed("id", "a_id"), "a_id").join(at, "b_id").select(F.col("a_id").alias("v"), ((F.col("x") + F.col("bx")) / 2).alias("_x"), ((F.col("y") + F.col("by")) / 2).alias("_y"))
    for end in "01":
        m = to.select(F.col("v").alias(f"v{end}"), "_x", "_y")
        g = g.join(m, f"v{end}", "left").withColumns({f"x{end}": F.coalesce("_x", f"x{end}"), f"y{end}": F.coalesce("_y", f"y{end}")}).drop("_x", "_y")
    return g.select(cls.columns)


def delete_lines(cls: DataFrame, edges: DataFrame, p: Params, isolated: float = 10.0) -> DataFrame:
    """Connecting lines without those that have a free end and fit a linked edge badly, again and again, and then without short isolated ones.

    A line fits badly if an edge is missing, it projects to nothing on one, it
    runs at a larger angle than allowed, or lies farther off than allowed.
    """
    seg = edges.select(F.col("objectid").alias("edge"), *[F.col(c).alias(f"e{c}") for c in ("x0", "y0", "x1", "y1")])
    link = cls.select("objectid", F.explode(F.split("linked_feat_id", "#")).alias("edge"), "x0", "y0", "x1", "y1").join(seg, "edge", "left")
    t = lambda e: project_t(f"x{e}", f"y{e}", "ex0", "ey0", "ex1", "ey1")
    off = F.greatest(*[point_segment(f"x{e}", f"y{e}", "ex0", "ey0", "ex1", "ey1") for e in "01"])
    turn = angle(F.expr("x1 - x0"), F.expr("y1 - y0"), F.expr("ex1 - ex0"), F.expr("ey1 - ey0"))
    most = math.radians(p.cl_edge_max_angle)
    bad = F.col("ex0").isNull() | (F.abs(t("0") - t("1")) < 1e-9) | ((turn > most) & (turn < math.pi - most)) | (off > p.cl_edge_max_dist)
    poor = cut(link.where(bad).select("objectid").distinct())
    left = cut(cls)
    while True:
        g = graph_edges(left, 0.01)
        free = half_edges(g).join(graph_vertices(half_edges(g)).where("degree = 1").select("v"), "v").select(F.col("eid").alias("objectid")).distinct()
        gone = cut(poor.join(free, "objectid", "left_semi").join(left.select("objectid"), "objectid", "left_semi"))
        if not gone.limit(1).count():
            break
        left = cut(left.join(gone, "objectid", "left_anti"))
    short = left.where(distance("x0", "y0", "x1", "y1") < isolated).withColumnRenamed("objectid", "id")
    near = segments_near(short, left.withColumnRenamed("objectid", "id"), 0.1, strict=False).where("a_id <> b_id").select(F.col("a_id").alias("id")).distinct()
    alone = short.select("id").join(near, "id", "left_anti").withColumnRenamed("id", "objectid")
    return left.join(alone, "objectid", "left_anti")


def update_lines(cls: DataFrame, edges: DataFrame, p: Params) -> DataFrame:
    """Connecting lines with the geometry of their edges: the fictitious one's part if only one is fictitious, else the mean of both; lines without a part go."""
    ids = F.split("linked_feat_id", "#")
    base = cls.select("*", F.get(ids, F.lit(0)).alias("ea"), F.get(ids, F.lit(1)).alias("eb"))
    cols = ("x0", "y0", "x1", "y1")
    for side in "ab":
        base = base.join(edges.select(F.col("objectid").alias(f"e{side}"), F.col("fictitious").alias(f"f{side}"), *[F.col(c).alias(f"{side}{c}") for c in cols]), f"e{side}", "left")
        for end in "01":
            t = project_t(f"x{end}", f"y{end}", f"{side}x0", f"{side}y0", f"{side}x1", f"{side}y1")
            base = base.withColumns({f"{side}t{end}": t})
    known = F.col("ax0").isNotNull() & F.col("bx0").isNotNull()
    kept = base.where(~known | ((F.abs(F.col("at0") - F.col("at1")) > 1e-9) & (F.abs(F.col("bt0") - F.col("bt1")) > 1e-9)))
    fa, fb = F.col("fa") == "true", F.col("fb") == "true"

    def new(axis: str, end: str):
        a = along(f"a{axis}0", f"a{axis}1", f"at{end}")
        b = along(f"b{axis}0", f"b{axis}1", f"bt{end}")
        return F.when(~known, F.col(f"{axis}{end}")).when(fa & ~fb, a).when(fb & ~fa, b).otherwise((a + b) / 2)

    return kept.select(*[new(c[0], c[1]).alias(c) if c in cols else F.col(c) for c in cls.columns])


def continue_lines(before: DataFrame, after: DataFrame, edges: DataFrame) -> DataFrame:
    """``after`` with the ends that shared a vertex in ``before`` moved to their centroid, where the linked edges of both sides are the same or meet."""
    g = graph_edges(before, 0.01)
    h = half_edges(g, keep=("linked_feat_id",)).select("v", "eid", "dir", "linked_feat_id")
    touch = half_edges(graph_edges(edges)).select("v", F.col("eid").alias("edge"))
    meets = touch.alias("p").join(touch.alias("q"), "v").select(F.col("p.edge").alias("e1"), F.col("q.edge").alias("e2")).distinct()
    pair = h.alias("p").join(h.alias("q"), "v").where("p.eid < q.eid").select("v", F.col("p.eid").alias("c1"), F.col("p.dir").alias("d1"), F.col("q.eid").alias("c2"), F.col("q.dir").alias("d2"), F.split("p.linked_feat_id", "#").alias("l1"), F.split("q.linked_feat_id", "#").alias("l2"))
    for k in (0, 1):
        m = meets.select(F.col("e1").alias(f"a{k}"), F.col("e2").alias(f"b{k}"))
        pair = pair.withColumns({f"a{k}": F.get("l1", F.lit(k)), f"b{k}": F.get("l2", F.lit(k))}).join(m, [f"a{k}", f"b{k}"], "left_semi")
    ends = pair.select("v", F.explode(F.array(F.struct(F.col("c1").alias("eid"), F.col("d1").alias("dir")), F.struct(F.col("c2").alias("eid"), F.col("d2").alias("dir")))).alias("e")).select("v", "e.*").distinct()
    at = half_edges(graph_edges(after, 0.01)).select("eid", "dir", "x", "y")
    mid = ends.join(at, ["eid", "dir"])
    w = Window.partitionBy("v")
    mid = mid.select("eid", "dir", F.avg("x").over(w).alias("mx"), F.avg("y").over(w).alias("my"))
    out = after
    for d, end in ((1, "0"), (-1, "1")):
        out = out.join(mid.where(F.col("dir") == d).select(F.col("eid").alias("objectid"), F.col("mx").alias("_x"), F.col("my").alias("_y")), "objectid", "left").withColumns({f"x{end}": F.coalesce("_x", f"x{end}"), f"y{end}": F.coalesce("_y", f"y{end}")}).drop("_x", "_y")
    return out.select(after.columns)


def retag(edges: DataFrame, ids: DataFrame, tag: str) -> DataFrame:
    """Edges with ``tag`` as w_tag of those with the ids."""
    return update(edges, ids.select("objectid").distinct().withColumn("w_tag", F.lit(tag)))
