"""Feature tables of a line network.

Feature tables are read from Parquet or JDBC.  The stand-in network has no
geography: it is computed from the keys of ``orders`` by integer arithmetic, an
order being one two-vertex edge of a chunk of seven, so that every operator can
be run at any scale and checked against SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from borderloom.functions.geometry import point

PAIR = "be#fr"
#: edges of a chunk
CHUNK = 7


def read_table(spark: SparkSession, path: str, filter_text: str | None = None) -> DataFrame:
    """A feature table stored as Parquet; the filter and the columns used reach the scan."""
    df = spark.read.parquet(path)
    return df.where(filter_text) if filter_text else df


def read_jdbc(spark: SparkSession, url: str, table: str, id_column: str, bounds: tuple[int, int], partitions: int, filter_text: str | None = None, **options) -> DataFrame:
    """A feature table of a database, read in parallel by ranges of a numeric id."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=id_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions, pushDownPredicate=True, **options)
    df = reader.load()
    return df.where(filter_text) if filter_text else df


def _node(m: str, p: str = "p") -> tuple[str, str]:
    return f"cast(25 * ({m}) + {p} * (({m}) % 4) as double)", f"cast(((37 * ({m})) % 61) - 30 + {p} * ((({m}) % 5) - 2) as double)"


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges (objectid, k, m, p, country, fictitious, form_of_way, priority, status, x0, y0, x1, y1, geom)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    e = o.withColumns({"m": F.expr("k div 2"), "p": F.expr("k % 2")}).withColumn("r", F.expr("m % 7"))
    e = e.withColumns({"a": F.expr("case when r = 6 then m - 4 else m end"), "b": F.expr("case when r < 5 then m + 1 else m - 2 end")})
    (ax, ay), (bx, by) = _node("a"), _node("b")
    e = e.withColumns({"x0": F.expr(ax), "y0": F.expr(ay)})
    e = e.withColumns({"x1": F.expr(f"case when r = 6 then x0 + 5 else {bx} end"), "y1": F.expr(f"case when r = 6 then y0 + 12 else {by} end")})
    return e.select(
        F.col("k").cast("string").alias("objectid"), "k", "m", "p",
        F.expr("case when p = 0 then 'be' else 'fr' end").alias("country"),
        F.expr("case when status = 'F' then 'true' else 'false' end").alias("fictitious"),
        F.expr("case when priority = '1-URGENT' then 'walkway' when priority = '5-LOW' then 'tractor_road' else 'road' end").alias("form_of_way"),
        "priority", "status", "x0", "y0", "x1", "y1", F.array(point("x0", "y0"), point("x1", "y1")).alias("geom"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-vertex lines (line_id, country, geom), the chain of each whole chunk and country."""
    e = edges(spark, sf_dir).where("m % 7 < 5")
    parts = e.groupBy(F.expr("m div 7").alias("i"), "p").agg(F.sort_array(F.collect_list(F.struct("m", "x0", "y0", "x1", "y1"))).alias("s"))
    whole = parts.where(F.size("s") == 5)
    geom = F.concat(F.transform("s", lambda t: point(t["x0"], t["y0"])), F.array(point(F.element_at("s", -1)["x1"], F.element_at("s", -1)["y1"])))
    return whole.select(F.expr("2 * i + p").alias("line_id"), F.expr("case when p = 0 then 'be' else 'fr' end").alias("country"), geom.alias("geom"))


def _rectangle(x0: str, y0: str, x1: str, y1: str):
    corner = lambda x, y: point(F.expr(x), F.expr(y))
    return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir).select(F.expr("m div 7").alias("i")).distinct()


def water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping rectangles a chunk (poly_id, country, ring), a watercourse and standing water."""
    c = _chunks(spark, sf_dir)
    a = c.select(F.expr("concat('A', i)").alias("poly_id"), F.lit(PAIR).alias("country"), _rectangle("175 * i + 10.37D", "-25.13D", "175 * i + 60.29D", "5.17D").alias("ring"))
    b = c.select(F.expr("concat('B', i)").alias("poly_id"), F.lit(PAIR).alias("country"), _rectangle("175 * i + 45.41D", "-10.23D", "175 * i + 110.19D", "20.31D").alias("ring"))
    return a.union(b)


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land of both countries in rectangles of a chunk's width: be above y = 0, fr below."""
    c = _chunks(spark, sf_dir)
    be = c.select(F.expr("concat('be', i)").alias("poly_id"), F.lit("be").alias("country"), _rectangle("175 * i - 10D", "0D", "175 * i + 165D", "10000D").alias("ring"))
    fr = c.select(F.expr("concat('fr', i)").alias("poly_id"), F.lit("fr").alias("country"), _rectangle("175 * i - 10D", "-10000D", "175 * i + 165D", "0D").alias("ring"))
    return be.union(fr).withColumn("land_cover_type", F.lit("land_area"))


def boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The border y = 0 in pieces of 175 m (objectid, country, boundary_type, x0, y0, x1, y1)."""
    c = _chunks(spark, sf_dir)
    return c.select(
        F.expr("concat('B', i)").alias("objectid"), F.lit(PAIR).alias("country"), F.lit("international_boundary").alias("boundary_type"),
        F.expr("175 * i - 10D").alias("x0"), F.lit(0.0).alias("y0"), F.expr("175 * i + 165D").alias("x1"), F.lit(0.0).alias("y1"),
    )


def connecting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connecting lines of the same m in both countries (objectid, country, linked_feat_id, x0, y0, x1, y1): the mean of their ends."""
    e = edges(spark, sf_dir).where("m % 7 < 5")
    be, fr = (e.where(F.col("p") == p).select("m", *[F.col(c).alias(f"{c}_{p}") for c in ("k", "x0", "y0", "x1", "y1")]) for p in (0, 1))
    mean = lambda c: ((F.col(f"{c}_0") + F.col(f"{c}_1")) / 2).alias(c)
    return be.join(fr, "m").select(F.concat(F.lit("CONNECTINGLINE"), "m").alias("objectid"), F.lit(PAIR).alias("country"), F.concat_ws("#", "k_0", "k_1").alias("linked_feat_id"), "m", *map(mean, ("x0", "y0", "x1", "y1")))
