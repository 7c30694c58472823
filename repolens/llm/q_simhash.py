"""Query op4: near-duplicates of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import simhash
from .registry import register, table

SHINGLE, DISTANCE = 3, 3


@register("op4_simhash_dedup")
def op4_simhash_dedup(spark, sf_dir):
    out = simhash.near_dedup(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
