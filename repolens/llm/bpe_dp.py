"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token exactly one token can end its encoding.
The automaton of the vocabulary gives, at every position, the tokens that
are suffixes of the prefix (its suffix links, longest first); a token is
the last one if the rest is empty and it encodes alone as itself, or if it
is compatible with the last token of the rest.  Back-pointers from the end
give the ids, equal to those of the merge loop, in a time that grows with
the matches, not with merges.

Two tokens are compatible if merging their joined bytes yields them again.
Merges run in rank order, so the boundary falls only to a merge of one node
of the left token's right edge with one node of the right token's left edge
that comes before either node is absorbed by its own parent (at equal rank
the leftmost merge wins).  ``compatible`` walks both edges upwards.

Defined results: a null text is empty (no ids); repeated rows and equal or
null doc_ids are encoded row by row; an empty table gives no rows; columns
other than doc_id and text are ignored.  Ids that the vocabulary lacks
decode to nothing; bytes that are not UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import NEVER, Pieces, Vocabulary, load_spec, on_worker

BATCH_TEXT = 2 << 20      # code points encoded before a batch is handed on
ROWS = 256                # rows read from a batch at once


class Encoder:
    def __init__(self, spec: dict):
        v = self.vocab = Vocabulary(spec)
        self.made = {c: (rank, a, b) for rank, (a, b, c) in enumerate(spec["merges"])}
        self.edges: dict[tuple[int, int], list] = {}
        self.matches = ahocorasick.Automaton()
        for t, raw in v.tokens.items():
            # a token that does not encode alone as itself can end a prefix, but not start one
            self.matches.add_word(raw.decode("latin-1"), (t, len(raw), v.merge(raw) == [t]))
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces = Pieces(v, self._packed, b"".join)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Nodes of one edge (1 left, 2 right) of a token's merge tree, leaf
        first, each with the rank of the merge that absorbs it (NEVER for
        the token)."""
        known = self.edges.get((token, side))
        if known is None:
            known, node = [(token, NEVER)], token
            while node in self.made:
                absorbed = self.made[node][0]
                node = self.made[node][side]
                known.append((node, absorbed))
            known.reverse()
            self.edges[token, side] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        a, b, i, j = self._edge(left, 2), self._edge(right, 1), 0, 0
        rank_of = self.vocab.rank_of
        while True:
            (x, x_gone), (y, y_gone) = a[i], b[j]
            rank = rank_of(x << 20 | y)
            if rank is not None and rank < x_gone and rank <= y_gone:
                return False
            if x_gone == y_gone == NEVER:
                return True
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1

    def piece(self, data: bytes) -> list[int]:
        n, pairs = len(data), self.pairs
        last, size = [-1] * n + [0], [0] * (n + 1)     # by the prefix's last byte; the empty prefix is at -1
        last[-1] = 0
        for end, (token, length, alone) in self.matches.iter(data.decode("latin-1")):
            if last[end] >= 0:
                continue
            rest = end - length
            if rest < 0:
                fits = alone
            elif last[rest] < 0:
                continue
            else:
                key = last[rest] << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = self.compatible(last[rest], token)
                    if len(pairs) < 250_000:
                        pairs[key] = fits
            if fits:
                last[end], size[end] = token, length
        out, at = [], n - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def _packed(self, piece: str) -> bytes:
        return array("i", self.piece(piece.encode("utf-8"))).tobytes()

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as packed 32-bit integers."""
        return b"".join(array("i", [self.vocab.added[part]]).tobytes() if i % 2 else self.pieces.text(part)
                        for i, part in enumerate(self.vocab.parts(text)))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()


class Decoder:
    def __init__(self, spec: dict):
        raw = spec["tokens"] | {i: s.encode("utf-8") for s, i in spec["added"].items()}
        size = max(raw) + 1
        self.sizes = np.array([len(raw.get(i, b"")) for i in range(size)] + [0], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flat = np.frombuffer(b"".join(raw.get(i, b"") for i in range(size)), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens' bytes side by side, read as UTF-8."""
        known = len(self.sizes) - 1
        ids = np.where((ids >= 0) & (ids < known), ids, known)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends) or not ends[-1]:
            return ""
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.flat[at].tobytes().decode("utf-8", "replace")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    for a in range(0, batch.num_rows, ROWS):
        rows = batch.slice(a, ROWS)
        yield from zip(rows.column("doc_id").to_pylist(), (t or "" for t in rows.column("text").to_pylist()))


def _encoded(doc_ids: list, packed: list[bytes], more: dict[str, pa.Array]) -> pa.RecordBatch:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed]).astype(np.int32)
    ids = pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32())
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()),
                                       "ids": pa.ListArray.from_arrays(pa.array(ends), ids)} | more)


def _run(docs: DataFrame, tokenizer_file: str, back: bool, keep: dict[str, Column] | None = None) -> DataFrame:
    keep = keep or {}
    kept = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(load_spec(tokenizer_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = on_worker("encode", shared, Encoder)
        decoder = on_worker("decode", shared, Decoder) if back else None

        def put(doc_ids, packed, rows):
            more = {"text": pa.array([decoder.decode(np.frombuffer(p, np.int32)) for p in packed], pa.string())} if back else {}
            return _encoded(doc_ids, packed, more | {c: rows.column(c) for c in kept})

        for batch in batches:
            doc_ids, packed, held, done = [], [], 0, 0
            for doc_id, text in _texts(batch):
                doc_ids.append(doc_id)
                packed.append(encoder.packed(text) if text else b"")
                held += len(text)
                if held >= BATCH_TEXT:
                    yield put(doc_ids, packed, batch.slice(done, len(doc_ids)))
                    doc_ids, packed, held, done = [], [], 0, done + len(doc_ids)
            if doc_ids:
                yield put(doc_ids, packed, batch.slice(done, len(doc_ids)))

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c.alias(n) for n, c in keep.items()])
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in src.schema.fields[2:])
    return src.mapInArrow(run, "doc_id long, ids array<int>" + ", text string" * back + kinds)


def encode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """One row per input row: doc_id, ids (array<int>)."""
    return _run(docs, tokenizer_file, back=False)


def round_trip(docs: DataFrame, tokenizer_file: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one pass: doc_id, ids, the text decoded
    from the ids, and the expressions of ``keep`` by name."""
    return _run(docs, tokenizer_file, back=True, keep=keep)


def decode(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """One row per input row of (doc_id, ids): doc_id, ids, text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_spec(tokenizer_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = on_worker("decode", shared, Decoder)
        for batch in batches:
            col = batch.column("ids")
            flat, ends = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            texts = ["" if ok is False else decoder.decode(flat[a:b])
                     for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), col.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), col, pa.array(texts, pa.string())],
                                             ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
