"""Equi-join of many rows with a table of unique keys, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in ``SHARES`` of all rows is hot.
SHARES = 1000


def hot_join(rows: DataFrame, keys: DataFrame, on: str | list[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``keys`` by the columns ``on`` (inner; nulls find
    nothing). A key is once in ``keys``, whose column ``weight`` says how many
    of the ``total`` rows have it.

    The rows of hot keys stay where they are: there are less than ``SHARES``
    such keys whatever the input, so theirs is a broadcast of bounded size. All
    others are shuffled, no key of which is more than a thousandth of the
    rows. Both inputs should be written tables, as they are read twice.
    """
    hot = F.col(weight) > total / SHARES
    on = [on] if isinstance(on, str) else on
    few = F.broadcast(keys.filter(hot).drop(weight))
    rest = rows.join(few.select(*on), on, "left_anti").join(keys.filter(~hot).drop(weight), on)
    return rows.join(few, on).unionByName(rest)
