"""Generated date spine (inclusive at both ends)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_START = _dt.date(2020, 1, 1)


def _date(x) -> Column:
    if x is None:
        # today + 365 days, as in the reference; pass a fixed date in tests.
        return F.date_add(F.current_date(), 365)
    if isinstance(x, Column):
        return x
    return F.lit(str(x)).cast("date")


def date_spine(spark: SparkSession, start=DEFAULT_START, end=None) -> DataFrame:
    """One row per day from ``start`` to ``end``; ``end`` defaults to today + 365.

    The spine has (end - start + 1) rows: a bound fixed by its parameters,
    not by data volume, so it is safe to broadcast.
    """
    return (spark.range(1)
            .select(F.explode(F.sequence(_date(start), _date(end), F.expr("INTERVAL 1 DAY"))).alias("date_day")))
