"""Token counts with a whole-token shortcut.

``whole_tokens`` proves offline, on the driver, which vocabulary strings
are one pre-token that the merges turn into one token.  Those pre-tokens
count 1 by a lookup; only the rest is merged.

Defined results: a null text is empty (0 bytes, 0 tokens); repeated rows
and equal or null doc_ids are counted row by row; an empty table gives no
rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import Pieces, Vocabulary, load_spec, on_worker

ROWS = 256                # rows read from a batch at once


def whole_tokens(vocab: Vocabulary) -> list[str]:
    """Vocabulary strings that, as a pre-token, encode alone as one token."""
    out = []
    for i, raw in vocab.tokens.items():
        try:
            s = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if vocab.pieces(s) == [s] and vocab.merge(raw) == [i]:
            out.append(s)
    return out


class Counter:
    def __init__(self, spec: dict):
        self.vocab = Vocabulary(spec)
        self.whole = frozenset(spec["whole"])
        self.pieces = Pieces(self.vocab, self._piece, sum)

    def _piece(self, piece: str) -> int:
        return 1 if piece in self.whole else len(self.vocab.merge(piece.encode("utf-8")))

    def count(self, text: str) -> int:
        parts = self.vocab.parts(text)
        return len(parts) // 2 + sum(map(self.pieces.text, parts[::2]))


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit."""
    spec = load_spec(tokenizer_file)
    spec["whole"] = whole_tokens(Vocabulary(spec))
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = on_worker("count", shared, Counter)
        for batch in batches:
            tokens = []
            for a in range(0, batch.num_rows, ROWS):
                tokens += [counter.count(t) if t else 0 for t in batch.slice(a, ROWS).column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"),
                                              pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return (src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
