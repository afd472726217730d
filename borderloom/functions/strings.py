"""Multi-valued attributes: values joined with ``#``, lists joined with ``/``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str
SEP = "#"
PROTECTED = "CONNECTINGLINE"


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def values(c: C, sep: str = SEP) -> Column:
    return F.split(col(c), sep)


def joined(*parts: C, sep: str = SEP) -> Column:
    return F.concat_ws(sep, *[col(p) for p in parts])


def is_double(country: C) -> Column:
    """Whether a country code names a border pair, which marks a connecting line."""
    return col(country).contains(SEP)


def is_protected(objectid: C) -> Column:
    return col(objectid).contains(PROTECTED)


def ordered_pair(country_a: C, a: C, country_b: C, b: C) -> Column:
    """a#b, in the order of their countries."""
    first = col(country_a) <= col(country_b)
    return F.when(first, joined(a, b)).otherwise(joined(b, a))


def merged(a: C, b: C) -> Column:
    """Merge of two attribute values: one where they are equal or one is null, else both."""
    return F.when(col(a).isNull() | (col(a) == col(b)), F.coalesce(col(a), col(b))).when(col(b).isNull(), col(a)).otherwise(joined(a, b))


def merged_json(a: C, b: C) -> Column:
    """Merge of two JSON arrays of strings, distinct values in order."""
    read = lambda c: F.coalesce(F.from_json(col(c), "array<string>"), F.array())
    return F.to_json(F.array_distinct(F.concat(read(a), read(b))))


def linked_id(linked: C, countries: C, country: C) -> Column:
    """The id that stands in ``linked`` where ``country`` stands in ``countries``; null where it doesn't or ids run out."""
    at = F.array_position(values(countries), col(country)).cast("int")
    ids = values(linked)
    return F.when((at > 0) & (at <= F.size(ids)), F.get(ids, at - 1))


def common_tag(a: C, b: C) -> Column:
    """The one value that two tags share; null if they share none or several."""
    both = F.array_intersect(values(a), values(b))
    return F.when(F.size(both) == 1, F.get(both, F.lit(0)))
