"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; all but the last return the columns of documents.
Cases (null or empty texts, repeated rows, null ids, empty tables) are those
of the operators in ``repolens.llm`` that the stages call.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.llm import bpe_dp, exact_dedup, mixing, simhash, toxicity
from repolens.llm.q_mixing import BLOCK_ROWS, WEIGHTS
from repolens.llm.q_simhash import DISTANCE, SHINGLE
from repolens.llm.q_tokens import TOKENIZER
from repolens.llm.registry import table
from repolens.llm.stored import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows among
    ``docs``, does not find toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row of the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-copies connect, the row of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, SHINGLE, DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mixture."""
    return mixing.in_mixed_order(docs, WEIGHTS, BLOCK_ROWS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256 (of the text decoded
    from the ids) and the place in the mixture of every row: the mixing stage
    writes it as the order of files and of rows in a file, which later reads
    and shuffles need not keep, so it is put down here (null if ``docs`` does
    not come from files)."""
    done = bpe_dp.round_trip(docs, public_tokenizers.path(TOKENIZER), _place(docs))
    return done.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"), "mixed_file", "mixed_row")


def _place(docs: DataFrame) -> dict[str, Column]:
    """Number of the file (files are written in name order) and of the row in it."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:       # rows of no file
        return {"mixed_file": F.lit(None).cast("long"), "mixed_row": F.lit(None).cast("long")}
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    return {"mixed_file": F.when(number != "", number).cast("long"), "mixed_row": F.col("_metadata.row_index")}


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("bpe", encode)]

# A trained network, chunk recipes and merges are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))      # written as Parquet: each stage runs once
    return STAGES[-1][1](spark, docs, sf_dir)
