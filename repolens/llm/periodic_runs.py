"""Maximal repetitions (runs) of the words of each text, and the texts with
every repetition collapsed to its first period.

A run is a stretch of consecutive words with smallest period q, of at least
``max(least, 2 * q)`` words, that no neighbouring word extends keeping the
period.  Runs are found without comparing all pairs of positions:

1. Periods under ``DIRECT`` are read off by comparing the words with
   themselves that many words on.  These are also the first of the highly
   periodic regions that step 2 leaves out.
2. At each dyadic scale t = 2, 4, 8, ... a string synchronising set is
   selected: position i is in it if the least hash of the t-word strings that
   start in i..i+t is that at i or at i+t.  Strings of period t / 3 or less
   (known from smaller scales) are left out.  Whether a position is in the set
   depends on the 2t words from it on alone, so a run of period 3t <= q < 6t
   has a position of the set in its first period and the same one a period
   later.  Pairs of positions with equal 2t words at such a distance propose
   periods; as those words have no period of t / 3 or less, they occur at most
   18 times in 6t words.
3. The only runs without such a pair are those whose period is itself wholly
   a highly periodic region; the ends of these regions propose them.
4. Proposals are extended both ways by comparing hashes of strings (binary
   search), then checked word by word.  Equal strings have equal hashes, so
   none is missed; a run that a clash of hashes made too long is extended
   anew, word by word.  Of the stretches with the same ends the smallest
   period stays.

Texts are worked on side by side, the longest first, so that a scale touches
only those that are long enough for it.  Work is about n log n in the words,
memory about 150 bytes a word of ``GROUP_BYTES`` of text, or of one longer
text; no shuffle.

Defined results: a null text has no words and collapses to the empty text;
empty texts likewise; rows that repeat a doc_id, or have none, each get their
own result; an empty table gives no rows; columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import slices

DIRECT = 6                 # periods under this are compared directly
GROUP_BYTES = 1 << 20      # text that is worked on side by side
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base & 0xFFFFFFFFFFFFFFFF
    return np.multiply.accumulate(out)


class Line:
    """Texts (arrays of word numbers) side by side with a separator of its own
    behind each; hashes of their strings."""

    def __init__(self, texts: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.word = np.full(int((self.sizes + 1).sum()), -1, np.int64)
        top = 0
        for a, t in zip(self.starts.tolist(), texts):
            self.word[a:a + len(t)] = t
            top = max(top, int(t.max(initial=0)))
        ends = self.starts + self.sizes
        self.word[ends] = top + 1 + np.arange(len(texts))
        n = len(self.word)
        self.n = n
        self.back = _powers(pow(_BASE, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(self.word.astype(np.uint64) + _U(1)) * _powers(_BASE, n), out=self.sums[1:])

    def hashes(self, at: np.ndarray, size) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.back[at]

    def windows(self, size: int, upto: int) -> np.ndarray:
        """Hashes of the strings of ``size`` words from every position before
        ``upto`` on that fits."""
        m = max(0, min(upto, self.n - size + 1))
        return _mix((self.sums[size:size + m] - self.sums[:m]) * self.back[:m])


def _stretches(hit: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First position and size of the runs of consecutive numbers in ``hit``
    (sorted) of at least ``least``."""
    if not len(hit):
        return hit, hit
    cut = np.flatnonzero(np.diff(hit) != 1) + 1
    first, last = np.append(0, cut), np.append(cut, len(hit))
    use = last - first >= least
    return hit[first[use]], (last - first)[use]


def _least_ahead(key: np.ndarray, n: int) -> np.ndarray:
    """Least of each ``n`` consecutive values."""
    size, out = 1, key
    while size * 2 <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < n:
        out = np.minimum(out[:len(out) - (n - size)], out[n - size:])
    return out


def synchronising(line: Line, t: int, upto: int, periodic: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set of scale ``t`` among the first
    ``upto``; ``periodic``: positions whose t words have a period of t / 3 or
    less."""
    key = line.windows(t, upto)
    never = ~_U(0)
    key[periodic[:len(key)]] = never
    if len(key) <= t:
        return np.zeros(0, np.int64)
    low = _least_ahead(key, t + 1)
    m = len(low)
    return np.flatnonzero((low != never) & ((low == key[:m]) | (low == key[t:t + m])))


def pairs(line: Line, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``at`` with the same 2t words 3t to 6t - 1 words on:
    (position, distance)."""
    at = at[at + 2 * t <= line.n]
    key = line.hashes(at, 2 * t)
    order = np.argsort(key)
    key, at = key[order], at[order]
    twin = np.zeros(len(key), bool)
    if len(key) > 1:
        same = key[1:] == key[:-1]
        twin[1:] = same
        twin[:-1] |= same
    key, at = key[twin], at[twin]
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    left, distance, step = [], [], 1
    while step < len(at):
        d = at[step:] - at[:-step]
        close = (key[step:] == key[:-step]) & (d < 6 * t)
        if not close.any():
            break
        use = close & (d >= 3 * t)
        left.append(at[:-step][use])
        distance.append(d[use])
        step += 1
    return (np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *distance]))


def _reach(line: Line, a: np.ndarray, b: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words from ``a`` and ``b`` on (or before them) agree, by
    hashes; ``most`` is known not to be passed."""
    low, high = np.zeros(len(a), np.int64), most + 1
    while True:
        open_ = high - low > 1
        if not open_.any():
            return low
        mid = np.where(open_, (low + high) // 2, low)
        if ahead:
            same = line.hashes(a, mid) == line.hashes(b, mid)
        else:
            same = line.hashes(a - mid, mid) == line.hashes(b - mid, mid)
        low = np.where(same, mid, low)
        high = np.where(same, high, mid)


def _exactly(word: np.ndarray, a: int, q: int) -> tuple[int, int]:
    """The stretch of period ``q`` around words ``a`` and ``a + q``."""
    if word[a] != word[a + q]:
        return a, a
    start, end = a, a + q + 1
    while start > 0 and word[start - 1] == word[start - 1 + q]:
        start -= 1
    while end < len(word) and word[end] == word[end - q]:
        end += 1
    return start, end


def extended(line: Line, a: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (start, end, period), each once, of period ``q`` around
    positions ``a`` and ``a + q``, that are two periods long at least."""
    whose = np.searchsorted(line.starts, a, "right") - 1
    begin, stop = line.starts[whose], line.starts[whose] + line.sizes[whose]
    inside = a + q < stop
    a, q, begin, stop = a[inside], q[inside], begin[inside], stop[inside]
    end = a + q + _reach(line, a, a + q, stop - a - q, True)
    start = a - _reach(line, a, a + q, a - begin, False)
    use = end - start >= 2 * q
    a, q, start, end = a[use], q[use], start[use], end[use]
    order = np.lexsort((end, q, start))
    a, q, start, end = a[order], q[order], start[order], end[order]
    new = np.ones(len(a), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1]) | (q[1:] != q[:-1])
    proposals, of = (a, q), np.cumsum(new) - 1
    q, start, end = q[new], start[new], end[new]
    # word by word
    size = end - start - q
    first = np.cumsum(size) - size
    wrong = np.zeros(len(q), bool)
    for lo, hi in _pieces(size):
        at = np.arange(size[lo:hi].sum()) + np.repeat(start[lo:hi] - (first[lo:hi] - first[lo]), size[lo:hi])
        bad = line.word[at] != line.word[at + np.repeat(q[lo:hi], size[lo:hi])]
        wrong[lo:hi] = np.logical_or.reduceat(bad, first[lo:hi] - first[lo])
    if wrong.any():          # a clash of hashes: each proposal anew
        anew = [(*_exactly(line.word, i, p), p) for i, p in zip(*(x[wrong[of]].tolist() for x in proposals))]
        start, end, q = (np.append(x[~wrong], [r[k] for r in anew]) for k, x in enumerate((start, end, q)))
    use = end - start >= 2 * q
    return start[use], end[use], q[use]


def _pieces(size: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``size`` of about ``most`` in sum."""
    total = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _distinct(start: np.ndarray, end: np.ndarray, q: np.ndarray):
    """Of stretches with the same ends, the one of the smallest period."""
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(q), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], q[new]


def runs(texts: list[np.ndarray], least: int = 12) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text (word numbers): starts, lengths and periods of its runs, by
    start and period."""
    if least < 2 * DIRECT:
        raise ValueError(f"least must be {2 * DIRECT} or more")
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    line = Line([texts[i] for i in order])
    found = [[], [], []]
    for q in range(1, DIRECT):
        # runs of three periods count as periodic regions below
        first, size = _stretches(np.flatnonzero(line.word[:-q] == line.word[q:]), min(2 * q, least - q))
        for into, x in zip(found, (first, first + size + q, np.full(len(first), q))):
            into.append(x)
    known = _distinct(*(np.concatenate(x) for x in found))
    longest = int(line.sizes[0]) if len(texts) else 0
    t = DIRECT // 3
    while 6 * t <= longest:
        # texts of two periods of 3t words
        upto = int((line.sizes[line.sizes >= 6 * t] + 1).sum())
        start, end, q = known
        region = (3 * q <= t) & (end - start >= t) & (start < upto)
        rs, re = start[region], end[region]
        inside = np.zeros(upto + 1, np.int64)
        np.add.at(inside, rs, 1)
        np.add.at(inside, np.minimum(re - t + 1, upto), -1)
        at, distance = pairs(line, synchronising(line, t, upto, np.cumsum(inside)[:upto] > 0), t)
        # regions that hold a whole period: each of their ends with all distances
        long = (re - rs >= 3 * t) & (re + 2 * t <= line.n)
        rs, re = rs[long], re[long]
        size = np.minimum(re - rs, 6 * t - 1) - 3 * t + 1
        ends = np.repeat(re, size)
        d = 3 * t + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = line.hashes(ends, 2 * t) == line.hashes(ends - d, 2 * t)
        at, distance = np.append(at, (ends - d)[same]), np.append(distance, d[same])
        if len(at):
            known = _distinct(*(np.append(x, y) for x, y in zip(known, extended(line, at, distance))))
        t *= 2
    start, end, q = known
    use = end - start >= np.maximum(least, 2 * q)
    start, end, q = start[use], end[use], q[use]
    order_ = np.lexsort((q, start))
    start, end, q = start[order_], end[order_], q[order_]
    cuts = np.searchsorted(start, line.starts)
    out: list = [None] * len(texts)
    for k, i in enumerate(order):
        part = slice(cuts[k], cuts[k + 1] if k + 1 < len(order) else len(start))
        out[i] = (start[part] - line.starts[k], (end - start)[part], q[part])
    return out


# ------------------------------------------------------------------ texts
def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    group, held = [], 0
    for t in texts:
        group.append(t or "")
        held += len(t or "")
        if held >= GROUP_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


def collapse(texts: list[str], least: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """Per text: its number of words, its runs, and the words joined by one
    space without those that repeat earlier ones of a run."""
    number = defaultdict(count().__next__)
    # white space of the words is that of ASCII, as bytes.split() has it
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    numbers = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
    for w, (start, length, period) in zip(words, runs(numbers, least)):
        if not len(start):
            yield len(w), [], b" ".join(w)
            continue
        edge = np.zeros(len(w) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        found = [{"start": s, "length": n, "period": q} for s, n, q in zip(start.tolist(), length.tolist(), period.tolist())]
        yield len(w), found, b" ".join(compress(w, (np.cumsum(edge)[:-1] == 0).tolist()))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start and length in
    words, period; by start and period), collapsed (the words left, joined by
    one space)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1024):
                done = [x for g in _groups(part.column("text").to_pylist()) for x in collapse(g, least)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([n for n, _, _ in done], pa.int64()),
                     pa.array([r for _, r, _ in done], RUNS),
                     pa.array([c.decode("utf-8", "surrogatepass") for _, _, c in done], pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return src.mapInArrow(run, "doc_id long, n_words long, "
                               "runs array<struct<start: long, length: long, period: long>>, collapsed string")
