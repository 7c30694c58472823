"""Query op13: runs of the words of all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import periodic_runs
from .registry import register, table

LEAST = 12


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the doc_id ends in 0, the words from
    one that it names on repeat the first of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.col("n"), F.lit(1))        # texts without words keep their text
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")

    def part(array: Column, first: Column, size: Column) -> Column:
        return F.slice(array, (first + 1).cast("int"), size.cast("int"))

    again = F.array_repeat(part(F.col("w"), a, p), F.ceil((n - a) / p).cast("int"))
    edited = F.concat(part(F.col("w"), F.lit(0), a), part(F.flatten(again), F.lit(0), n - a))
    return (docs.select("doc_id", "text")
            .withColumn("w", F.when(F.pmod(h, F.lit(10)) == 0, words))
            .withColumn("n", F.size("w").cast("long"))
            .select("doc_id", F.when(F.col("n") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from ``find_runs``."""
    runs = F.col("runs")
    longest = F.reduce(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"),
                       lambda best, x: F.when(best.isNull() | (x["length"] > best["length"]), x).otherwise(best))
    line = F.transform(runs, lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    return (found.withColumn("best", longest)       # runs are by start and period: the first of the longest
            .select("doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


@register("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    return digest(periodic_runs.find_runs(with_periods(table(spark, sf_dir, "documents")), LEAST))
