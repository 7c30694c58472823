"""Query op11: quality of all documents."""

from __future__ import annotations

from . import quality
from .registry import register, table

THRESHOLD = 0.3


@register("op11_quality")
def op11_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), THRESHOLD)
