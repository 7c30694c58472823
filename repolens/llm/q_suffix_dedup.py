"""Query op2: repeated 50-byte strings removed from all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import suffix_dedup
from .registry import register, table

LENGTH = 50


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), LENGTH)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
