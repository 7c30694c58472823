"""Mixing sources to target weights by Pfair scheduling.

Every source is a stream of blocks (``block_rows`` documents in pseudo-random
order).  With weights in whole parts of a period L, block i of a stream of
weight w gets the release time floor(i*L/w) and the deadline
ceil((i+1)*L/w), and each slot goes to the released block with the earliest
deadline.  The weights fill the period, so after t slots every stream has
had more than t*w/L - 1 and fewer than t*w/L + 1 blocks.  The schedule
repeats with the period, so one period (as long as the weights say, whatever
the data) is computed, as one expression, and a block's slot is arithmetic.

When a stream has run out its slots stay empty and the others go on in the
same order: every row of the input is in the result once.

A row's place in its stream comes from counts by (stream, hash bucket), so a
source of any share of the rows is spread over all buckets.

Defined results: sources without a weight, and null ones, form the stream
``other``; a null doc_id is ordered like an empty one; repeated rows follow
each other; an empty table gives no rows; other columns are passed on.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stored import packed

OTHER = "other"
_P = "__mix_"             # prefix of working columns


def check_weights(weights: dict[str, int]) -> dict[str, int]:
    if OTHER not in weights or min(weights.values()) < 1:
        raise ValueError(f"weights must be positive and include {OTHER!r}")
    unit = gcd(*weights.values())
    return {k: w // unit for k, w in sorted(weights.items())}


def period(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """One period: (stream, turn, weight, length, release, deadline, at);
    ``at`` is the slot of the stream's block number ``turn``."""
    weights = check_weights(weights)
    length = sum(weights.values())
    names, parts = list(weights), list(weights.values())
    w = F.array(*map(F.lit, parts))
    n = F.lit(length)

    def pick(state, t):
        """The released stream of the earliest deadline."""
        waiting = F.transform(w, lambda x, i: F.struct(
            F.ceil((F.get(state["done"], i) + 1) * n / x).alias("deadline"), i.alias("i"),
            F.floor(F.get(state["done"], i) * n / x).alias("release")))
        return F.array_min(F.filter(waiting, lambda x: x["release"] <= t))["i"]

    start = F.struct(F.array_repeat(F.lit(0), len(parts)).alias("done"),
                     F.array().cast("array<int>").alias("picks"))
    run = F.aggregate(
        F.sequence(F.lit(0), F.lit(length - 1)), start,
        lambda s, t: F.get(F.transform(F.array(pick(s, t)), lambda p: F.struct(
            F.transform(s["done"], lambda d, i: d + (i == p).cast("int")).alias("done"),
            F.concat(s["picks"], F.array(p)).alias("picks"))), F.lit(0)),
        lambda s: s["picks"])
    slots = spark.range(1).select(F.posexplode(run).alias("at", "i"))
    turns = Window.partitionBy("i").orderBy("at")
    named = slots.withColumn("turn", F.row_number().over(turns) - 1)
    weight = F.get(w, F.col("i"))
    return named.select(
        F.get(F.array(*map(F.lit, names)), F.col("i")).alias("stream"), "turn", weight.alias("weight"),
        n.alias("length"), F.floor(F.col("turn") * n / weight).alias("release"),
        F.ceil((F.col("turn") + 1) * n / weight).alias("deadline"), F.col("at").cast("long").alias("at"))


def mix(docs: DataFrame, weights: dict[str, int], block_rows: int) -> DataFrame:
    """``docs`` with a column ``mix``: struct of stream, rank (in the
    stream), block, release, deadline, slot and place (in the block).  The
    mixed order is (slot, place)."""
    weights = check_weights(weights)
    source = F.coalesce("source", F.lit(OTHER))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.withColumns({
        f"{_P}stream": F.when(source.isin(*[k for k in weights if k != OTHER]), source).otherwise(OTHER),
        f"{_P}key": key, f"{_P}bucket": F.substring(key, 1, 3)})
    group = [f"{_P}stream", f"{_P}bucket"]
    # 4096 rows a stream: the rows before each bucket
    before = Window.partitionBy(group[0]).orderBy(group[1]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
               .select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"{_P}before")))
    inside = Window.partitionBy(group).orderBy(f"{_P}key", F.col("doc_id"))
    ranked = (rows.withColumn(f"{_P}in", F.row_number().over(inside) - 1).join(offsets, group, "left")
              .withColumn(f"{_P}rank", F.col(f"{_P}before") + F.col(f"{_P}in")))
    plan = period(docs.sparkSession, weights).select(*[F.col(c).alias(f"{_P}p_{c}") for c in (
        "stream", "turn", "weight", "length", "release", "deadline", "at")])
    w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col(f"{_P}stream")].cast("long")
    blocks = (ranked.withColumn(f"{_P}block", F.expr(f"{_P}rank div {int(block_rows)}"))
              .withColumns({f"{_P}turn": F.col(f"{_P}block") % w,
                            f"{_P}cycle": F.floor(F.col(f"{_P}block") / w)}))
    out = blocks.join(F.broadcast(plan),                      # as many rows as the weights have parts
                      (F.col(f"{_P}stream") == F.col(f"{_P}p_stream")) & (F.col(f"{_P}turn") == F.col(f"{_P}p_turn")), "left")
    base = F.col(f"{_P}cycle") * F.col(f"{_P}p_length")
    return out.select(*[docs[c] for c in docs.columns], F.struct(
        F.col(f"{_P}stream").alias("stream"), F.col(f"{_P}rank").alias("rank"), F.col(f"{_P}block").alias("block"),
        (base + F.col(f"{_P}p_release")).alias("release"), (base + F.col(f"{_P}p_deadline")).alias("deadline"),
        (base + F.col(f"{_P}p_at")).alias("slot"),
        (F.col(f"{_P}rank") % block_rows).alias("place")).alias("mix"))


def in_mixed_order(docs: DataFrame, weights: dict[str, int], block_rows: int) -> DataFrame:
    """All rows of ``docs``, its columns, sorted in the mixed order (across
    and within partitions, so written files hold the stream in file order)."""
    # the input's columns travel as one, so none of their names can clash
    mixed = mix(docs.select(packed(docs).alias("doc"), "doc_id", "source"), weights, block_rows)
    slot, place = F.col("mix.slot"), F.col("mix.place")
    return mixed.repartitionByRange(slot, place).sortWithinPartitions(slot, place).select("doc.*")
