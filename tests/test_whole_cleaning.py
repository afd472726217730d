
from borderloom.plans import q_steps
from borderloom.plans.params import Params

from .test_network import areas, edges


def test_clean_antennas_until_none_is_left(spark, monkeypatch):
    land = areas(spark, ("be", (-10, 0, 210, 100)), ("fr", (-10, -200, 210, 0)))
    dangles = [(k, 50, 50, 10 * k, -100) for k in range(3, 8)]  # five at one base, all mostly abroad
    rows = edges(spark, (1, 0, 50, 50, 50), (2, 50, 50, 100, 50), *dangles, (8, 100, 50, 150, 50), (9, 100, 50, 100, 90), ("c", 0, 50, -50, 50, "be#fr"))
    monkeypatch.setattr(q_steps.net, "edges", lambda *_: rows)
    monkeypatch.setattr(q_steps.net, "land", lambda *_: land)
    monkeypatch.setattr(q_steps, "TN", Params())
    got = {r.objectid for r in q_steps.h4(spark, "").collect()}
    assert got.isdisjoint("34567") and {"1", "2", "8", "9", "c"} <= got
