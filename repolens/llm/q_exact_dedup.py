"""Query op8: exact duplicates of all documents."""

from __future__ import annotations

from . import exact_dedup
from .registry import register, table

ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
  FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       CAST(strlen(t.x) AS BIGINT) AS n_bytes, sha256(t.x) AS text_sha256
FROM t JOIN g USING (x)
"""


@register("op8_exact_dedup", ORACLE)
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
