"""Latest-row-per-key de-duplication.

``row_number() over (partition by key order by ingestion_timestamp desc,
<tie-breaks>) = 1``.  Catalyst turns this into a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so each
map task already keeps one row per key: a key that holds a third of all
rows is reduced map-side and never lands whole in one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import LANDED_AT

ORDER_COLUMN = "ingestion_timestamp"


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str = ORDER_COLUMN,
                   tie_breaks: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row per key.

    Ties on ``order_col`` are broken by ``tie_breaks`` (descending, NULLs
    last) so the result does not depend on partitioning; pass every other
    column for a total order.
    """
    order = [F.col(order_col).desc_nulls_last()] + [F.col(t).desc_nulls_last() for t in tie_breaks]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row_num", F.row_number().over(w)).filter(F.col("_row_num") == 1).drop("_row_num")


def tie_breaks_for(df: DataFrame, keys: Sequence[str], order_col: str = ORDER_COLUMN) -> list[str]:
    """All columns except the key and the ordering column: when the row's file
    landed and the source's own ``updated_at`` first (of two snapshots in one
    batch the later one wins), then in schema order."""
    skip = set(keys) | {order_col}
    rest = [f for f in df.columns if f not in skip]
    return sorted(rest, key=lambda f: (f != LANDED_AT, f != "updated_at"))
