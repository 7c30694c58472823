"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints link at ``distance`` or fewer differing bits; documents are
grouped by connected components.  Only distinct fingerprints are searched.

Placement: a fingerprint of 64 bits is cut into distance + 1 blocks, and
what is left of it without one block into distance + 1 blocks again.  Two
linked fingerprints are equal in at least one such pair of blocks, so
meeting by (pair, bits) loses no link.  Meeting places with one fingerprint
are left out by their count.  A place with more than ``TILE`` fingerprints
is split by the bits in which its own fingerprints differ, again into
distance + 1 blocks and as often as needed (``split_places``): a row is sent
distance + 1 times a round, whatever the place holds.

Search in a place: fingerprints are sorted by Gray rank, where neighbours
differ in few bits.  Every ``FANOUT`` neighbours have a node that holds the
bits they share (mask and pattern), and so on upwards.  Pairs of nodes are
followed downwards while the differences in bits shared on both sides are
within the distance; if all other bits fit as well, the two groups are
linked as a whole; if both are in one component already, they are skipped.
A place returns links from each fingerprint to its component's least one,
not pairs.

Defined results: a null text is empty; a text without words has the
fingerprint zero; a null doc_id gets its row's result and never names a
component (a component without doc_id is null); repeated rows are kept; an
empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import slices
from .components import connected_components
from .stored import rows_of, stored

SEED = 42
TILE = 2048
FANOUT = 8
PAIRS = 20_000            # pairs of nodes that are followed at once


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # A-Z; space and \x09-\x0D
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
    counts = np.zeros(64, np.int64)
    for a in range(0, len(h), 65536):
        counts += np.unpackbits(h[a:a + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """One row per input row: doc_id, row (hash of the text), fp (the 64
    bits as a long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for part in slices(batch)
                            for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(fps.view(np.int64))],
                                             ["doc_id", "row", "fp"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row(docs), "text")
    return src.mapInArrow(run, "doc_id long, row long, fp long")


def _row(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("row")


# ------------------------------------------------------------------ search in a place
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class _Joined:
    """Disjoint sets over 0..n-1; every set is named by its least member."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.of[a], self.of[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while (up := self.of[self.of]).tobytes() != self.of.tobytes():
                self.of = up


def _index(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels from the fingerprints up: (mask of shared bits, their pattern,
    first fingerprint of each node)."""
    levels = [(np.full(len(x), ~np.uint64(0)), x, np.arange(len(x)))]
    while len(levels[-1][0]) > FANOUT:
        mask, value, first = levels[-1]
        at = np.arange(0, len(mask), FANOUT)
        every, some = np.bitwise_and.reduceat(value, at), np.bitwise_or.reduceat(value, at)
        shared = ~(every ^ some) & np.bitwise_and.reduceat(mask, at)
        levels.append((shared, every & shared, first[at]))
    return levels


def linked(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) between distinct ``fps`` (uint64) that
    give their components at ``distance`` or fewer differing bits."""
    x = fps[np.argsort(gray_rank(fps), kind="stable")]
    n, sets = len(x), _Joined(len(x))
    levels = _index(x)
    top = len(levels) - 1
    i, j = np.triu_indices(len(levels[top][0]))
    todo = [(top, i, j)]
    while todo:
        level, i, j = todo.pop()
        if len(i) > PAIRS:
            todo += [(level, i[PAIRS:], j[PAIRS:])]
            i, j = i[:PAIRS], j[:PAIRS]
        mask, value, first = levels[level]
        common = mask[i] & mask[j]
        differ = np.bitwise_count((value[i] ^ value[j]) & common)
        keep = differ <= distance
        if level == 0:
            sets.join(i[keep], j[keep])
            continue
        # nodes whose fingerprints are in one set already
        low, high = np.minimum.reduceat(sets.of, first), np.maximum.reduceat(sets.of, first)
        keep &= (low[i] != high[j]) | (low[j] != high[i])
        whole = keep & (differ + np.bitwise_count(~common) <= distance)
        last = np.append(first[1:], n)
        for a, b in zip(i[whole].tolist(), j[whole].tolist()):
            sets.join(np.arange(first[a], last[a]), np.full(last[a] - first[a], first[b]))
            sets.join(np.arange(first[b], last[b]), np.full(last[b] - first[b], first[a]))
        i, j = i[keep & ~whole], j[keep & ~whole]
        size = len(levels[level - 1][0])
        c = np.arange(FANOUT)
        a = np.repeat(i[:, None] * FANOUT + c, FANOUT, axis=1).ravel()
        b = np.tile(j[:, None] * FANOUT + c, (1, FANOUT)).ravel()
        ok = (a < size) & (b < size) & (a <= b)
        if ok.any():
            todo.append((level - 1, a[ok], b[ok]))
    member = np.flatnonzero(sets.of != np.arange(n))
    return x[member], x[sets.of[member]]


def _search(distance: int):
    """Links of consecutive rows with one place (sorted by place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(src, dst):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(src).view(np.int64)),
                                               pa.array(np.concatenate(dst).view(np.int64))], ["src", "dst"])

        open_place, held = None, []

        def close():
            x = np.unique(np.concatenate(held))
            if len(x) > 1:
                return linked(x, distance)
            return x[:0], x[:0]

        for batch in batches:
            places = batch.column("place").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fps):
                continue
            cuts = np.flatnonzero(places[1:] != places[:-1]) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(fps))
            src, dst = [], []
            sizes = ends - starts
            # places of two rows inside the batch, all at once
            inside = np.ones(len(starts), bool)
            inside[0] = inside[-1] = False
            two = np.flatnonzero(inside & (sizes == 2))
            a, b = fps[starts[two]], fps[starts[two] + 1]
            near = np.bitwise_count(a ^ b) <= distance
            src.append(np.maximum(a, b)[near])
            dst.append(np.minimum(a, b)[near])
            rest = np.ones(len(starts), bool)
            rest[two] = False
            for s, e in zip(starts[rest].tolist(), ends[rest].tolist()):
                place = int(places[s])
                if place != open_place:
                    if held:
                        x, y = close()
                        src.append(x)
                        dst.append(y)
                    open_place, held[:] = place, []
                held.append(fps[s:e])
            yield put(src, dst)
        if held:
            yield put(*[[v] for v in close()])
    return run


# ------------------------------------------------------------------ placement
def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` (positions) cut into ``parts`` runs of nearly equal length."""
    ends = [len(bits) * k // parts for k in range(parts + 1)]
    return [bits[a:b] for a, b in zip(ends, ends[1:])]


def meeting_masks(distance: int) -> list[int]:
    """Bit masks, of which two patterns at ``distance`` or fewer differing
    bits are equal under at least one."""
    every = list(range(64))
    out = []
    for block in _blocks(every, distance + 1):
        rest = [b for b in every if b not in block]
        out += [sum(1 << b for b in block + other) for other in _blocks(rest, distance + 1)]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Links (src, dst) whose components are those of all linked pairs of
    the distinct fingerprints in column ``fp``."""
    masks = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(_signed(m)).alias("m"))
                      for k, m in enumerate(meeting_masks(distance))])
    places: Column = F.xxhash64(F.col("x.k"), F.col("fp").bitwiseAND(F.col("x.m")))
    met = nodes.select("fp", F.explode(masks).alias("x")).select("fp", places.alias("place"))
    found = []
    while True:
        sizes = _sizes(met)
        # in ``distance`` bits no more than 2 ** distance fingerprints differ, and all of them link
        many = (F.col("n") > TILE) & (F.bit_count("differ") > distance)
        found.append(met.join(sizes.filter(~many).select("place"), "place"))
        crowded = sizes.filter(many)
        if crowded.isEmpty():
            break
        met = stored(split_places(met, crowded, distance))
    return (reduce(DataFrame.unionByName, found).repartition("place").sortWithinPartitions("place")
            .mapInArrow(_search(distance), "src long, dst long"))


def _sizes(met: DataFrame) -> DataFrame:
    """Places of two or more fingerprints: how many, and in which bits they
    differ; map-side combined."""
    return stored(met.groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("differ")).filter("n > 1"))


def split_places(met: DataFrame, crowded: DataFrame, distance: int) -> DataFrame:
    """The fingerprints of crowded places in smaller ones.

    The bits in which a place's fingerprints differ are cut into
    ``distance`` + 1 blocks: of two at ``distance`` or fewer differing bits
    one block is equal, so they meet again under it.  Each fingerprint goes to
    ``distance`` + 1 places, each with a quarter fewer differing bits (at
    distance 3), so a few rounds end with at most ``TILE`` in every place; no
    place is ever sent in pairs of parts."""
    bits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i.cast("int")),
                    lambda i: F.getbit(F.col("differ"), i) == 1)
    n = F.size("bits")

    def block(j: int) -> Column:
        first, end = F.floor(n * j / (distance + 1)).cast("int"), F.floor(n * (j + 1) / (distance + 1)).cast("int")
        # every bit once: their sum is their union (the sign bit's value is negative, as it should be)
        mask = F.reduce(F.slice("bits", first + 1, end - first), F.lit(0).cast("bigint"),
                        lambda m, i: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
        return F.struct(F.lit(j).alias("j"), mask.alias("mask"))

    masks = crowded.withColumn("bits", bits).select("place", F.explode(F.array(*map(block, range(distance + 1)))).alias("b"))
    return met.join(masks, "place").select(
        "fp", F.xxhash64("place", "b.j", F.col("fp").bitwiseAND(F.col("b.mask"))).alias("place"))


def near_dedup(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """One row per input row: doc_id, row (hash of the text), fp (long),
    component_id (the smallest doc_id that links lead to, its own included),
    root (the component's least fingerprint)."""
    fps = stored(fingerprints(docs, shingle))
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    comps = connected_components(links(nodes, distance))
    rooted = stored(nodes.join(comps, nodes["fp"] == comps["node"], "left")
                    .select("fp", "first", F.coalesce("component", "fp").alias("root")))
    names = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = stored(rooted.join(names, "root", "left").select("fp", "root", "component_id"))
    # both sides are stored, so a hot fingerprint's rows can be split over tasks
    return fps.join(named, "fp", "left").select("doc_id", "row", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest
    doc_id (a null one only if there is no other; then, and where a doc_id
    repeats, the least hash of the text)."""
    keep = (near_dedup(docs, shingle, distance).groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("first"))
            .select(F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("mark")))
    return rows_of(docs, _row(docs), keep)
