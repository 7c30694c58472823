"""Query op9: all documents mixed to target weights."""

from __future__ import annotations

from . import mixing
from .registry import register, table

# Parts of the mixture; sources that are not named share the last entry.
WEIGHTS = {"src0": 12, "src1": 8, "src2": 8, "src3": 6, "src4": 6, "src5": 5, "src6": 5, "src7": 5, "src8": 5, "src9": 4,
           "src10": 4, "src11": 4, "src12": 3, "src13": 3, "src14": 3, "src15": 3, "src16": 2, "src17": 2, "src18": 2,
           "src19": 2, "other": 8}
BLOCK_ROWS = 16

_W = sorted(WEIGHTS.items())
ORACLE = f"""
WITH RECURSIVE par AS (SELECT {[n for n, _ in _W]} AS names, {[w for _, w in _W]} AS w, {sum(WEIGHTS.values())} AS l),
st(t, done, pick) AS (
  SELECT 0, list_transform(w, lambda x: 0), 0 FROM par
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: d + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (SELECT t, done, list_min(list_transform(done, lambda d, i:
          CASE WHEN (d * l) // w[i] <= t THEN (((d + 1) * l + w[i] - 1) // w[i]) * 1000 + i ELSE 1000000000 END)) % 1000 AS p, l
        FROM st, par) s WHERE t < l),
plan AS (
  SELECT names[pick] AS stream, w[pick] AS w, l, t - 1 AS at_slot,
         row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn
  FROM st, par WHERE t > 0),
ranked AS (
  SELECT doc_id, stream,
         row_number() OVER (PARTITION BY stream ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS rank
  FROM (SELECT doc_id, CASE WHEN list_contains(names, coalesce(source, 'other')) THEN coalesce(source, 'other')
                            ELSE 'other' END AS stream FROM documents, par) d),
blocks AS (SELECT *, rank // {BLOCK_ROWS} AS block FROM ranked)
SELECT b.doc_id, b.stream, b.rank, b.block,
       (b.block // p.w) * p.l + (p.turn * p.l) // p.w AS release,
       (b.block // p.w) * p.l + ((p.turn + 1) * p.l + p.w - 1) // p.w AS deadline,
       (b.block // p.w) * p.l + p.at_slot AS slot,
       b.rank % {BLOCK_ROWS} AS place
FROM blocks b JOIN plan p ON b.stream = p.stream AND b.block % p.w = p.turn
"""


@register("op9_mix_sources", ORACLE)
def op9_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, WEIGHTS, BLOCK_ROWS).select("doc_id", "mix.*")
