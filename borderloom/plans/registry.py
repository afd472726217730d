"""Registered queries: a callable (spark, sf_dir) and, where SQL can express it, the same query for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The stand-in network in SQL; a query's own tables go on after it.
NET = """WITH net AS (SELECT o_orderkey AS k, o_orderkey // 2 AS m, o_orderkey % 2 AS p, o_orderpriority AS priority, o_orderstatus AS status FROM orders),
e0 AS (SELECT *, m % 7 AS r, CASE WHEN m % 7 = 6 THEN m - 4 ELSE m END AS a, CASE WHEN m % 7 < 5 THEN m + 1 ELSE m - 2 END AS b FROM net),
e1 AS (SELECT *, CAST(25 * a + p * (a % 4) AS DOUBLE) AS x0, CAST(((37 * a) % 61) - 30 + p * ((a % 5) - 2) AS DOUBLE) AS y0 FROM e0),
e2 AS (SELECT *, CASE WHEN r = 6 THEN x0 + 5 ELSE CAST(25 * b + p * (b % 4) AS DOUBLE) END AS x1, CASE WHEN r = 6 THEN y0 + 12 ELSE CAST(((37 * b) % 61) - 30 + p * ((b % 5) - 2) AS DOUBLE) END AS y1 FROM e1),
edges AS (SELECT CAST(k AS VARCHAR) AS objectid, k, m, p, r, m // 7 AS i, CASE WHEN p = 0 THEN 'be' ELSE 'fr' END AS country, CASE WHEN status = 'F' THEN 'true' ELSE 'false' END AS fictitious,
  CASE WHEN priority = '1-URGENT' THEN 'walkway' WHEN priority = '5-LOW' THEN 'tractor_road' ELSE 'road' END AS form_of_way, priority, status, x0, y0, x1, y1,
  sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS len FROM e2),
chunks AS (SELECT DISTINCT i FROM edges),
segs AS (SELECT 2 * i + p AS id, r AS pos, x0, y0, x1, y1, len, coalesce(sum(len) OVER (PARTITION BY i, p ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0,
  sum(len) OVER (PARTITION BY i, p) AS total, count(*) OVER (PARTITION BY i, p) AS n FROM edges WHERE r < 5 QUALIFY n = 5),
verts AS (SELECT id, pos, x0 AS x, y0 AS y, s0 AS s, total FROM segs UNION ALL SELECT id, 5, x1, y1, total, total FROM segs WHERE pos = 4),
rects AS (SELECT 'A' || i AS poly_id, i, 175 * i + 10.37::DOUBLE AS xa, -25.13::DOUBLE AS ya, 175 * i + 60.29::DOUBLE AS xb, 5.17::DOUBLE AS yb FROM chunks
  UNION ALL SELECT 'B' || i, i, 175 * i + 45.41::DOUBLE, -10.23::DOUBLE, 175 * i + 110.19::DOUBLE, 20.31::DOUBLE FROM chunks),
cls AS (SELECT 'CONNECTINGLINE' || a.m AS objectid, 'be#fr' AS country, a.k || '#' || b.k AS linked_feat_id, a.m, (a.x0 + b.x0) / 2 AS x0, (a.y0 + b.y0) / 2 AS y0, (a.x1 + b.x1) / 2 AS x1, (a.y1 + b.y1) / 2 AS y1
  FROM edges a JOIN edges b ON a.m = b.m AND a.p = 0 AND b.p = 1 WHERE a.r < 5)
"""
#: Share of an edge inside a rectangle as an interval of its parameter.
CLIP = """, clip AS (SELECT e.objectid, e.len, w.poly_id,
  greatest(0, CASE WHEN x1 > x0 THEN (xa - x0) / (x1 - x0) WHEN x1 < x0 THEN (xb - x0) / (x1 - x0) WHEN x0 BETWEEN xa AND xb THEN 0 ELSE 2 END,
              CASE WHEN y1 > y0 THEN (ya - y0) / (y1 - y0) WHEN y1 < y0 THEN (yb - y0) / (y1 - y0) WHEN y0 BETWEEN ya AND yb THEN 0 ELSE 2 END) AS t0,
  least(1, CASE WHEN x1 > x0 THEN (xb - x0) / (x1 - x0) WHEN x1 < x0 THEN (xa - x0) / (x1 - x0) ELSE 1 END,
           CASE WHEN y1 > y0 THEN (yb - y0) / (y1 - y0) WHEN y1 < y0 THEN (ya - y0) / (y1 - y0) ELSE 1 END) AS t1
  FROM edges e JOIN rects w ON w.i BETWEEN e.i - 1 AND e.i + 1)
"""


def query(name: str, sql: str | None = None, net: bool = True) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` goes on after the network's tables."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = (NET if net else "") + sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})
