"""Removal of passages that also start in an earlier document.

A byte goes if a string of ``length`` bytes over it also starts in a
document of smaller doc_id.  That is a question about longest previous
factors: at every position, does the longest match with earlier documents
reach ``length``?  It is answered with suffix arrays of parts of the corpus
that are cut so that all equal strings of ``length`` bytes meet in one part:

1. Every window of ``length`` bytes goes by the least hash of its
   ``GRAM``-byte strings, which equal windows share.  Neighbouring windows
   mostly share it too, so a run of them goes as one string.
2. Groups of documents (by a hash of the row) tell which hashes they have
   and how many different strings, and learn which hashes other documents
   have as well, and which of them are crowded: more than ``CROWD`` different
   strings have them (a frequent line, the edges of a shared passage).
3. Only runs with a shared hash travel, as strings.  Strings that are equal
   within a group travel once, for the smallest doc_id; the others are
   settled on the spot, so a passage of any number of copies sends one
   string a group.  Runs of a crowded hash are cut into their single windows,
   which go by the hash of all their bytes: different surroundings part,
   equal windows still meet, and again one of them a group travels.
4. Where the strings of a part of the hashes meet, equal ones are settled by
   their smallest doc_id, and over the remaining different ones a suffix
   array is built up to ``length`` bytes, 8 bytes at a time and of tying
   suffixes only, ties in document order.  ``previous_factors`` finds the nearest earlier document before and
   behind each suffix (previous and next smaller values), as far as the match
   reaches ``length``.
5. What goes returns to the documents' group.

Groups and parts of hashes grow in number with the bytes of the corpus
(``GROUP_BYTES``, ``PART_BYTES``), so a task's memory does not.

Defined results: a null text is empty; a null doc_id comes after all others;
rows that repeat a doc_id are one document here, which removes nothing from
itself, and each gets its own result; an empty table gives no rows; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 20
MOST_WINDOWS = 64         # of one travelling string
SLICE = 1 << 19           # windows that are hashed at once
GROUP_BYTES, LEAST_GROUPS = 8 << 20, 64     # text of a group of documents
PART_BYTES, LEAST_PARTS = 8 << 20, 256      # text of whose windows one part has the hashes
CROWD = 512               # different strings around one least hash that meet in one task
_LAST = np.iinfo(np.int64).max


# ------------------------------------------------------------------ bytes
def _words(flat: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, big-endian (``flat`` is padded)."""
    return np.ndarray((len(flat) - 7,), ">u8", flat.data, 0, (1,))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _runs(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int):
    """Runs of windows with one least hash: (first byte, windows, hash).
    ``starts``/``sizes``: documents of at least ``length`` bytes in ``flat``."""
    span = length - GRAM + 1
    words = _words(flat)
    out = []
    total = int(starts[-1] + sizes[-1]) - length + 1
    valid = np.ones(total, bool)                       # windows inside one document
    opens = np.zeros(total, bool)
    opens[starts] = True
    for end in (starts + sizes)[:-1].tolist():
        valid[end - length + 1:end] = False
    for a in range(0, total, SLICE):
        b = min(total, a + SLICE)
        w = words[a:b + length - 8].astype(np.uint64)
        n = len(w) - (GRAM - 8)
        h = np.zeros(n, np.uint64)
        for k in [*range(0, GRAM - 8, 8), GRAM - 8]:
            h = _mix((h ^ w[k:k + n]) * np.uint64(0x9E3779B97F4A7C15))
        n, step = 1, h
        while n * 2 <= span:                           # least of n hashes, doubling n
            step = np.minimum(step[:-n], step[n:])
            n *= 2
        if n < span:
            step = np.minimum(step[:len(step) - (span - n)], step[span - n:])
        least, ok = step[:b - a], valid[a:b]
        cut = opens[a:b].copy()
        cut[0] = True
        cut[1:] |= (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, b - a))
        use = ok[first]
        first, size = first[use], size[use]
        pieces = -(-size // MOST_WINDOWS)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, size = np.repeat(first, pieces) + k * MOST_WINDOWS, np.repeat(size, pieces) - k * MOST_WINDOWS
        out.append((first + a, np.minimum(size, MOST_WINDOWS), least[first]))
    return [np.concatenate(x) for x in zip(*out)]


def _string_hashes(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the strings ``flat[at:at+size]`` (8 bytes at least)."""
    words = _words(flat)
    last = at + size - 8
    h = _mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(0, int(size.max(initial=0)), 8):
        h = _mix(h ^ words[np.minimum(at + k, last)].astype(np.uint64)) + np.uint64(k)
    return h


def _same_as_first(flat: np.ndarray, at: np.ndarray, size: np.ndarray, order_key: np.ndarray, h: np.ndarray | None = None):
    """For strings ``flat[at:at+size]`` (8 bytes at least): the index of the
    equal string that comes first by ``order_key``.  Hashes (``h``, if they
    are known) propose, bytes decide."""
    words = _words(flat)
    last = at + size - 8
    if h is None:
        h = _string_hashes(flat, at, size)
    order = np.lexsort((order_key, h))
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    copy = np.flatnonzero(first != np.arange(len(first)))
    model = first[copy]
    equal = size[copy] == size[model]
    for k in range(0, int(size.max(initial=0)), 8):
        equal &= words[np.minimum(at[copy] + k, last[copy])] == words[np.minimum(at[model] + k, last[model])]
    first[copy[~equal]] = copy[~equal]                  # one hash, other bytes: on its own
    return first


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of intervals by document: sorted, not touching."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    base = doc.astype(np.int64) * (int(end.max()) + 2)   # documents side by side on one line
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(doc), bool)
    new[1:] = (base + start)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - base[last]


# ------------------------------------------------------------------ packets
def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays)] + [x.nbytes for x in arrays], np.int64).tobytes()
    kinds = "".join(f"{x.dtype.str:>4}" for x in arrays).encode()
    return zstandard.ZstdCompressor(level=3).compress(head + kinds + b"".join(x.tobytes() for x in arrays))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
    kinds = raw[8 + 8 * n:8 + 12 * n].decode()
    out, at = [], 8 + 12 * n
    for i, s in enumerate(sizes):
        kind = np.dtype(kinds[4 * i:4 * i + 4].strip())
        out.append(np.frombuffer(raw, kind, s // kind.itemsize, at))
        at += s
    return out


def _gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Strings of ``flat`` side by side."""
    first = np.cumsum(size) - size
    return flat[np.arange(size.sum()) + np.repeat(at - first, size)]


class Group:
    """Documents of a group (ord, bytes), their runs and hashes."""

    def __init__(self, docs: list[tuple[int, bytes]], length: int, parts: int):
        """``docs`` must be sorted; a document's number is its place."""
        numbers = [i for i, d in enumerate(docs) if len(d[1]) >= length]
        self.length, self.parts, self.number = length, parts, np.array(numbers, np.int64)
        self.ords = np.array([docs[i][0] for i in numbers], np.int64)
        if not numbers:
            self.at = self.least = self.part = np.zeros(0, np.int64)
            return
        sizes = np.array([len(docs[i][1]) for i in numbers], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(docs[i][1] for i in numbers) + bytes(8), np.uint8)
        self.at, count, least = _runs(self.flat, self.starts, sizes, length)
        self.size = count + length - 1
        self.doc = np.searchsorted(self.starts, self.at, "right") - 1
        self.part, self.least = self._place(least)

    def _place(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of hashes, and 32 further bits that tell those of a part
        apart; a clash only lets two meet."""
        return ((h % np.uint64(self.parts)).astype(np.int64),
                ((h // np.uint64(self.parts)) & np.uint64(0xFFFFFFFF)).astype(np.int64))

    def _by_part(self, index: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for i in np.split(index, np.flatnonzero(np.diff(self.part[index])) + 1):
            if len(i):
                yield int(self.part[i[0]]), i

    def hashes(self) -> Iterator[tuple[int, bytes]]:
        """Per part: its distinct hashes, whether two documents have them, how
        many different strings do, and 16 bits of the set of these strings."""
        if not len(self.at):
            return
        string = _string_hashes(self.flat, self.at, self.size)
        for part, i in self._by_part(np.lexsort((string, self.least, self.part))):
            h, o, s = self.least[i], self.ords[self.doc[i]], string[i]
            new = np.append(True, h[1:] != h[:-1])
            edge = np.flatnonzero(new)
            other = new | np.append(True, s[1:] != s[:-1])
            yield part, _pack(np.diff(h[edge], prepend=0).astype(np.uint32),
                              np.minimum.reduceat(o, edge) != np.maximum.reduceat(o, edge),
                              np.add.reduceat(other.astype(np.uint32), edge, dtype=np.uint32),
                              np.add.reduceat(np.where(other, s, np.uint64(0)), edge).astype(np.uint16))

    def strings(self, marked: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
        """Per part, the strings that travel (key: part, for single windows of
        crowded hashes behind all parts) and, at key -1, the removals that
        are settled here.  ``marked``: by part, the shared
        hashes and which of them are crowded."""
        if not len(self.at):
            return
        use, crowded = np.zeros(len(self.at), bool), np.zeros(len(self.at), bool)
        for part, i in self._by_part(np.argsort(self.part, kind="stable")):
            if part in marked:
                known, crowd = marked[part]
                k = np.minimum(np.searchsorted(known, self.least[i]), len(known) - 1)
                use[i] = known[k] == self.least[i]
                crowded[i] = use[i] & crowd[k]
        use = np.flatnonzero(use)
        if not len(use):
            return
        at, size = self.at[use], self.size[use]
        first = _same_as_first(self.flat, at, size, at)
        own, gone = self._settled(at, size, first)
        yield from gone
        whole, cut = own[~crowded[use[own]]], own[crowded[use[own]]]
        yield from self._sent(at[whole], size[whole], self.part[use[whole]], self.least[use[whole]])
        # crowded: single windows by the hash of all their bytes
        count = size[cut] - self.length + 1
        at = np.repeat(at[cut] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        h = np.concatenate([np.zeros(0, np.uint64), *(_string_hashes(self.flat, x, np.full(len(x), self.length))
                                                      for x in np.split(at, range(SLICE, len(at), SLICE)))])
        part, least = self._place(h)
        blocks = -(-len(at) // SLICE)
        block = part * blocks // self.parts                # a range of parts at a time
        for b in range(blocks):
            i = np.flatnonzero(block == b)
            size = np.full(len(i), self.length)
            own, gone = self._settled(at[i], size, _same_as_first(self.flat, at[i], size, at[i], h[i]))
            yield from gone
            yield from self._sent(at[i][own], size[own], self.parts + part[i][own], least[i][own])

    def _settled(self, at: np.ndarray, size: np.ndarray, first: np.ndarray):
        """Indices of the strings that are not settled by an equal one of an
        earlier document here (``first``), and the removals of the others."""
        doc = np.searchsorted(self.starts, at, "right") - 1
        settled = self.ords[doc] > self.ords[doc[first]]
        pos = at - self.starts[doc]
        d, a, b = _merge(doc[settled], pos[settled], (pos + size)[settled])
        return np.flatnonzero(~settled), [(-1, _pack(self.number[d], a, b))] if len(d) else []

    def _sent(self, at: np.ndarray, size: np.ndarray, part: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Packets of strings, by part."""
        doc = np.searchsorted(self.starts, at, "right") - 1
        order = np.lexsort((at, least, part))
        for i in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            if len(i):
                yield int(part[i[0]]), _pack(
                    np.diff(least[i], prepend=0).astype(np.uint32), self.ords[doc[i]],
                    self.number[doc[i]].astype(np.int32), (at - self.starts[doc])[i].astype(np.int32),
                    size[i].astype(np.int32), _gather(self.flat, at[i], size[i]))


def mark(packets: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """Of the hashes of one part by group: per group, those that two or more
    documents have, and whether more than ``CROWD`` different strings do
    (groups with the same set of strings count once)."""
    read = [_unpack(b) for _, b in packets]
    h = np.concatenate([np.cumsum(r[0], dtype=np.int64) for r in read])
    several, count, strings = (np.concatenate([r[k] for r in read]) for k in (1, 2, 3))
    whose = np.repeat(np.arange(len(packets)), [len(r[0]) for r in read])
    order = np.lexsort((strings, h))
    new = np.append(True, h[order][1:] != h[order][:-1])
    edge = np.flatnonzero(new)
    n = np.diff(np.append(edge, len(h)))
    shared, crowded = np.empty(len(h), bool), np.empty(len(h), bool)
    shared[order] = np.repeat((n > 1) | np.logical_or.reduceat(several[order], edge), n)
    other = new | np.append(True, strings[order][1:] != strings[order][:-1])
    crowded[order] = np.repeat(np.add.reduceat(np.where(other, count[order], 0).astype(np.int64), edge) > CROWD, n)
    out = []
    for k, i in enumerate(np.split(np.arange(len(h)), np.flatnonzero(np.diff(whose)) + 1)):
        i = i[shared[i]]
        if len(i):
            out.append((packets[k][0], _pack(np.diff(h[i], prepend=0).astype(np.uint32), crowded[i])))
    return out


# ------------------------------------------------------------------ step 2
def shared_windows(flat: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes that start at ``at`` and are compared up to ``length``
    bytes (8 or more): those that another one equals, ascending, and the rank
    of each in suffix order (equal strings have equal ranks).  Sorted by their
    first 8 bytes; only those that tie are sorted by the next 8, and so on."""
    words = _words(flat)
    live, rank = np.arange(len(at)), np.zeros(len(at), np.int64)
    for k in [*range(0, length - 8, 8), length - 8]:
        key = words[at[live] + k].astype(np.uint64)
        order = np.argsort(key) if not k else np.lexsort((key, rank))
        live, key, rank = live[order], key[order], rank[order]
        new = np.ones(len(live), bool)
        new[1:] = (key[1:] != key[:-1]) | (rank[1:] != rank[:-1])
        edge = np.append(np.flatnonzero(new), len(live))
        tie = np.repeat(np.diff(edge) > 1, np.diff(edge))
        live, rank = live[tie], np.cumsum(new)[tie]      # what stands alone has no match
        if not len(live):
            break
    order = np.argsort(live)
    return live[order], rank[order]


def previous_factors(rank: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (rank up to the wanted length, document order ``doc``, given
    in text order): for each the nearest suffix of a smaller document before
    it in suffix order, and behind it (previous and next smaller values), as
    far as the match reaches the wanted length; -1 if none does."""
    n = len(rank)
    order = np.lexsort((np.arange(n), rank))
    d, run = doc[order], rank[order]
    out = []
    for side in (1, -1):
        ds, rs = d[::side], run[::side]
        near = np.arange(n) - 1
        near[1:][rs[1:] != rs[:-1]] = -1
        while True:                                    # pointer jumping over values that are not smaller
            i = np.flatnonzero((near >= 0) & (ds[near] >= ds))
            if not len(i):
                break
            near[i] = near[near[i]]
        found = np.full(n, -1)
        place = order[::side]
        found[place] = np.where(near >= 0, place[near], -1)
        out.append(found)
    return out[0], out[1]


def settle(packets: list[tuple[int, bytes]], length: int) -> list[tuple[int, bytes]]:
    """Removals, by group, that follow from the strings of one part."""
    read = [_unpack(b) for _, b in packets]
    least = np.concatenate([np.cumsum(r[0], dtype=np.int64) for r in read])
    ords, number, pos, size = (np.concatenate([r[k] for r in read]).astype(np.int64) for k in range(1, 5))
    group = np.repeat([g for g, _ in packets], [len(r[0]) for r in read])
    flat = np.concatenate([*[r[5] for r in read], np.zeros(8, np.uint8)])
    at = np.cumsum(size) - size
    # hashes that only one document has
    order = np.argsort(least, kind="stable")
    edge = np.flatnonzero(np.append(True, least[order][1:] != least[order][:-1]))
    shared = np.minimum.reduceat(ords[order], edge) != np.maximum.reduceat(ords[order], edge)
    use = order[np.repeat(shared, np.diff(np.append(edge, len(order))))]
    if not len(use):
        return []
    use = use[np.lexsort((pos[use], number[use], group[use], ords[use]))]     # document order
    ords, number, group, pos, size = ords[use], number[use], group[use], pos[use], size[use]
    flat = np.concatenate([_gather(flat, at[use], size), np.zeros(8, np.uint8)])
    at = np.cumsum(size) - size
    first = _same_as_first(flat, at, size, np.arange(len(at)))
    whole = ords > ords[first]
    found = [(np.flatnonzero(whole), pos[whole], (pos + size)[whole])]
    # different strings: longest previous factors; if all are single windows, none has any
    own = np.flatnonzero((first == np.arange(len(first))) & (size.max() > length))
    text = np.concatenate([_gather(flat, at[own], size[own]), np.zeros(length + 8, np.uint8)])
    begin = np.cumsum(size[own]) - size[own]
    count = size[own] - length + 1
    of = np.repeat(np.arange(len(own)), count)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    met, rank = shared_windows(text, begin[of] + inside, length)
    before, behind = previous_factors(rank, ords[own][of[met]])
    hit = met[(before >= 0) | (behind >= 0)]
    goes, where = of[hit], inside[hit]
    s, a, b = _merge(goes, where, where + length)
    # a string's result holds for its copies in the same document
    same = np.flatnonzero(~whole)
    model = np.searchsorted(own, first[same])
    lo, hi = np.searchsorted(s, model, "left"), np.searchsorted(s, model, "right")
    k = hi - lo
    take = np.arange(k.sum()) + np.repeat(lo - (np.cumsum(k) - k), k)
    entry = np.repeat(same, k)
    found.append((entry, pos[entry] + a[take], pos[entry] + b[take]))
    entry, start, end = (np.concatenate([f[k] for f in found]) for k in range(3))
    # merge by document
    names = np.cumsum(np.append(False, (number[1:] != number[:-1]) | (group[1:] != group[:-1]) | (ords[1:] != ords[:-1])))
    doc, start, end = _merge(names[entry], start, end)
    head = np.flatnonzero(np.append(True, names[1:] != names[:-1]))[doc]
    number, group = number[head], group[head]
    order = np.argsort(group, kind="stable")
    return [(int(group[i[0]]), _pack(number[i], start[i], end[i]))
            for i in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(i)]


# ------------------------------------------------------------------ Spark
def _read(table: pa.Table) -> tuple[int | None, list[tuple[int, bytes]], list[int]]:
    """Group number, its sorted documents, and each one's row of ``table``."""
    if not table.num_rows:
        return None, [], []
    rows = sorted((o, t.encode("utf-8", "surrogatepass"), i) for i, (o, t) in enumerate(zip(
        table.column("ord").to_pylist(), table.column("text").to_pylist())))
    return table.column("g")[0].as_py(), [(o, t) for o, t, _ in rows], [i for _, _, i in rows]


def _packets(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"place": pa.array([p for p, _, _ in rows], pa.int64()), "g": pa.array([g for _, g, _ in rows], pa.int64()),
                     "blob": pa.array([b for _, _, b in rows], pa.binary())})


PACKETS = "place long, g long, blob binary"


def _tell(length: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        g, docs, _ = _read(table)
        return _packets([(p, g, b) for p, b in Group(docs, length, parts).hashes()])
    return run


def _send(length: int, parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        g, docs, _ = _read(left)
        marked = {}
        for p, b in zip(right.column("place").to_pylist(), right.column("blob").to_pylist()):
            hashes, crowded = _unpack(b)
            marked[p] = np.cumsum(hashes, dtype=np.int64), crowded
        return _packets([(p, g, b) for p, b in Group(docs, length, parts).strings(marked)])
    return run


def _by_place(work):
    """``work(packets of a place)`` over consecutive rows of a place; its
    results keep the place.  Packets at -1 pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            out = []
            for p, g, blob in zip(*(batch.column(c).to_pylist() for c in ("place", "g", "blob"))):
                if p == -1:
                    out.append((p, g, blob))
                    continue
                if p != place:
                    out += [(place, *x) for x in work(held)] if held else []
                    place, held = p, []
                held.append((g, blob))
            if out:
                yield from _packets(out).to_batches()
        if held:
            yield from _packets([(place, *x) for x in work(held)]).to_batches()
    return run


def _to_places(packets: DataFrame) -> DataFrame:
    """Packets of a place side by side; those at -1, which only pass, are
    spread by group."""
    return (packets.repartition("place", F.when(F.col("place") == -1, F.col("g")))
            .sortWithinPartitions("place"))


def _apply(left: pa.Table, right: pa.Table) -> pa.Table:
    """Texts of a group and its removals."""
    _, docs, places = _read(left)
    gone: dict[int, list[tuple[int, int]]] = {}
    if right.num_rows:
        read = [_unpack(b) for b in right.column("blob").to_pylist()]
        number, start, end = _merge(*(np.concatenate([r[k] for r in read]) for k in range(3)))
        for n, a, b in zip(number.tolist(), start.tolist(), end.tolist()):
            gone.setdefault(n, []).append((a, b))
    spans, kept, sizes = [], [], []
    for n, (_, data) in enumerate(docs):
        at, parts = 0, []
        for a, b in gone.get(n, ()):
            parts.append(data[at:a])
            at = b
        parts.append(data[at:])
        sizes.append(len(data))
        kept.append(b"".join(parts))
        spans.append([{"start": a, "end": b} for a, b in gone.get(n, ())])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"doc_id": left.column("doc_id").take(pa.array(places, pa.int64())), "n_bytes": pa.array(sizes, pa.int64()),
                     "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans (removed byte ranges,
    maximal, end exclusive), kept (the remaining bytes)."""
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} or more")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups, parts = max(LEAST_GROUPS, -(-total // GROUP_BYTES)), max(LEAST_PARTS, -(-total // PART_BYTES))
    # the three uses of this shuffle are one exchange
    src = src.select("doc_id", "text", F.coalesce("doc_id", F.lit(int(_LAST))).alias("ord"),
                     F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("long").alias("g"))
    by_group = src.groupBy("g")

    def meet(packets: DataFrame, work) -> DataFrame:
        return _to_places(packets).mapInArrow(_by_place(work), PACKETS)

    marked = meet(by_group.applyInArrow(_tell(length, parts), PACKETS), mark)
    strings = by_group.cogroup(marked.groupBy("g")).applyInArrow(_send(length, parts), PACKETS)
    gone = meet(strings, lambda packets: settle(packets, length))
    return by_group.cogroup(gone.groupBy("g")).applyInArrow(
        _apply, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
