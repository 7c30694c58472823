"""Lineage cuts in the shared checkpoint folder, and whole rows by their keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the folder of ``spark.checkpoint.dir`` and
    read from there: later jobs survive lost executors and don't compute it
    again.  Plans over it know its size (a checkpoint keeps the estimate of the
    plan before it, which grows without bound over the rounds of a loop)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever they are called."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def rows_of(docs: DataFrame, mark: Column, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id (null is a value) and ``mark`` are in
    ``keep`` (doc_id, mark), with all their columns; one of those that repeat
    both.  De-duplication and join have the same keys, so whole rows are
    shuffled once."""
    def keys(df: DataFrame, mark: Column) -> list[Column]:
        doc_id = df["doc_id"].cast("long")
        return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("none"), mark.alias("mark")]

    on = ["id", "none", "mark"]
    # the input's columns travel as one, so none of their names can clash
    rows = docs.select(packed(docs).alias("doc"), *keys(docs, mark)).dropDuplicates(on)
    return rows.join(keep.select(keys(keep, keep["mark"])), on, "left_semi").select("doc.*")
