"""Every query of the network operators, by name, with its SQL."""

from __future__ import annotations

from borderloom.plans import q_geometry, q_graph, q_steps, q_tables  # noqa: F401  they register
from borderloom.plans.registry import ORACLES, QUERIES, Query

FLAGSHIP = "step201_fill_fictitious"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
