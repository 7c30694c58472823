"""Queries op3 (token counts) and op6 (encoding and decoding)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe_dp, token_count
from .registry import register, table

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


@register("op3_token_count")
def op3_token_count(spark, sf_dir):
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


def encoded_digest(docs):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    done = bpe_dp.round_trip(docs, public_tokenizers.path(TOKENIZER))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


@register("op6_bpe_encode")
def op6_bpe_encode(spark, sf_dir):
    return encoded_digest(table(spark, sf_dir, "documents"))
