"""Exact duplicates by content-defined chunk recipes.

A text is normalised (A-Z lower-cased, nothing else), cut where a rolling
hash of its bytes says so, and described by its *recipe*: the ordered list
of its chunk identifiers.  Texts are equal when their recipes are equal.
Long texts move once, as chunks that are de-duplicated where they are cut
and then meet by identifier, where their bytes are compared: an identifier
that stands for two different byte strings is refused and every identifier
is drawn again with another key.  After that check, recipes alone decide.

Defined results: a null text is empty (recipe of no chunk, so all empty
texts are equal); a null ``doc_id`` is smaller than any other and its row
stays only where its text has no other; rows that repeat both doc_id and
text stay or go together (``drop_duplicates`` keeps one of them); an empty
table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import slices
from .stored import rows_of, stored

MASK_BITS = 10            # a boundary every 1024 bytes on average
MIN_CHUNK, MAX_CHUNK = 256, 8192
WINDOW = 16               # bytes that decide about a boundary
ID_BYTES = 12
MEMO_BYTES = 32 << 20     # chunks that a task remembers having sent


def normalise(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()   # bytes.lower: A-Z only


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; they depend on nearby bytes only
    (besides the least and greatest length)."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8)
    # two 8-byte words before every position, mixed into one hash
    words = np.ndarray((n - 7,), "<u8", data, 0, (1,))
    h = words[:-8] * np.uint64(0x9E3779B97F4A7C15) + words[8:] * np.uint64(0xC2B2AE3D27D4EB4F) if n >= WINDOW else b[:0]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    marks = np.flatnonzero(h >> np.uint64(64 - MASK_BITS) == 0) + WINDOW
    out, last = [], 0
    for m in marks.tolist():
        while m - last > MAX_CHUNK:
            last += MAX_CHUNK
            out.append(last)
        if m - last >= MIN_CHUNK:
            out.append(m)
            last = m
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        out.append(last)
    if last < n:
        out.append(n)
    return out


def chunk_id(chunk: bytes, key: int, size: int = ID_BYTES) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size, key=key.to_bytes(4, "big")).digest()


def _recipes(key: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1024)):
            recipes, shas, rows, lengths = [], [], [], []
            for text in batch.column("text").to_pylist():
                data = normalise(text)
                a, ids = 0, []
                for b in cuts(data):
                    ids.append(chunk_id(data[a:b], key, size))
                    a = b
                recipes.append(b"".join(ids))
                lengths.append(len(data))
                shas.append(hashlib.sha256(data).hexdigest())
                rows.append(hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(recipes, pa.binary()), pa.array(lengths, pa.int64()),
                 pa.array(shas, pa.string()), pa.array(rows, pa.string())],
                ["doc_id", "recipe", "n_bytes", "text_sha256", "row_sha256"])
    return run


class Sent:
    """Chunks a task has sent, the least recently met forgotten first.  One
    that is forgotten is sent again, so only the work depends on the bound."""

    def __init__(self, most: int = MEMO_BYTES):
        self.most, self.held = most, 0
        self.chunks: OrderedDict[tuple[bytes, bytes], None] = OrderedDict()

    def new(self, pair: tuple[bytes, bytes]) -> bool:
        if pair in self.chunks:
            self.chunks.move_to_end(pair)
            return False
        self.chunks[pair] = None
        self.held += len(pair[1])
        while self.held > self.most and len(self.chunks) > 1:
            self.held -= len(self.chunks.popitem(last=False)[0][1])
        return True


def _chunks(key: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent()
        for batch in (part for whole in batches for part in slices(whole, 1024)):
            out: list[tuple[bytes, bytes]] = []
            for text in batch.column("text").to_pylist():
                data = normalise(text)
                a = 0
                for b in cuts(data):
                    c = data[a:b]
                    if sent.new(pair := (chunk_id(c, key, size), c)):
                        out.append(pair)
                    a = b
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in out], pa.binary()), pa.array([c for _, c in out], pa.binary())],
                ["chunk_id", "chunk"])
    return run


def recipes(docs: DataFrame, key: int = 0, size: int = ID_BYTES) -> DataFrame:
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInArrow(_recipes(key, size),
                          "doc_id long, recipe binary, n_bytes long, text_sha256 string, row_sha256 string")


def chunks(docs: DataFrame, key: int = 0, size: int = ID_BYTES) -> DataFrame:
    """Chunks with their identifiers; a task does not send one again that it
    remembers, so a chunk of all documents moves once a task."""
    return docs.select("text").mapInArrow(_chunks(key, size), "chunk_id binary, chunk binary")


def _ambiguous(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifiers next to each other (sorted) with different bytes."""
    last = None
    for batch in batches:
        bad = []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if last is not None and last[0] == k and last[1] != c:
                bad.append(k)
            last = (k, c)
        yield pa.RecordBatch.from_arrays([pa.array(bad, pa.binary())], ["chunk_id"])


def ambiguous_ids(chunk_rows: DataFrame) -> DataFrame:
    """Identifiers that stand for different byte strings (normally none).
    A chunk that all documents share arrives once per task; neighbours of the
    sorted rows are compared, and no group is gathered."""
    return (chunk_rows.repartition("chunk_id").sortWithinPartitions("chunk_id")
            .mapInArrow(_ambiguous, "chunk_id binary"))


def verified_recipes(docs: DataFrame, size: int = ID_BYTES) -> DataFrame:
    """Recipes whose identifiers are verified to stand for one byte string
    each.  The check is one job; only the number of refused identifiers
    reaches the driver.  A refusal draws all identifiers anew, longer."""
    key = 0
    while not ambiguous_ids(chunks(docs, key, size)).isEmpty():
        key, size = key + 1, min(size + 4, 32)
    return recipes(docs, key, size)


def _decided(docs: DataFrame, id_bytes: int) -> DataFrame:
    """``exact_dedup`` with row_sha256 (of the text as it is) besides."""
    rows = stored(verified_recipes(docs, id_bytes))
    # map-side combined: a group of any size is one row per task here
    groups = stored(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # both sides are stored, so the rows of a hot recipe can be split over tasks
    return (rows.join(groups, "recipe", "left")
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "n_bytes", "text_sha256", "row_sha256"))


def exact_dedup(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest doc_id with an equal
    text), group_size, kept, n_bytes, text_sha256 (of the normalised text)."""
    return _decided(docs, id_bytes).drop("row_sha256")


def drop_duplicates(docs: DataFrame, id_bytes: int = ID_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    # rows of a doc_id may have equal texts in other letters: one of them stays
    keep = (_decided(docs, id_bytes).filter("kept").groupBy("doc_id", "text_sha256")
            .agg(F.min("row_sha256").alias("mark")).select("doc_id", "mark"))
    # texts are normalised in ``_recipes`` only; whole rows are found by the text as it is
    return rows_of(docs, F.sha2(F.coalesce("text", F.lit("")), 256), keep)
