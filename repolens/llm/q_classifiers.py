"""Queries op5 (toxicity) and op7 (language) of all documents."""

from __future__ import annotations

from . import langid, toxicity
from .registry import register, table


@register("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))
