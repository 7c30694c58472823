"""Query op10: fingerprints of all documents and of their edited texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import cws
from .registry import register, table


@register("op10_cws_fingerprint")
def op10_cws_fingerprint(spark, sf_dir):
    out = cws.fingerprints(table(spark, sf_dir, "documents"))
    return out.withColumns({c: cws.as_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")})
