"""Byte-level BPE vocabulary: tokens as bytes, merge ranks, pre-token pattern.

Read once on the driver (``load_spec``) and broadcast: its size is that of
the vocabulary file, whatever the data.  Workers build what they need from
it once per process (``on_worker``).

What is a letter, a number or white space depends on the Unicode version, in
which the tokenizers library and ``regex`` differ; the library decides.  Its
classes are read from it on the driver; texts with a character that the two
class differently are split by a pattern of the library's own classes.
"""

from __future__ import annotations

import gc
import json
from functools import cache
from typing import Any

import regex
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

NEVER = 1 << 60
# Fixed value: the split pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def _ranges(matches, text: str) -> str:
    """The body of a character class of the ranges (start, end) in ``text``."""
    return "".join(f"\\U{ord(text[a]):08x}-\\U{ord(text[b - 1]):08x}" for a, b in matches)


@cache
def library_classes() -> tuple[dict[str, str], str]:
    """Per class of ``CLASSES`` the body of a class of the characters that the
    library takes for it, and one of those that ``regex`` classes differently
    (empty if there are none)."""
    # the planes that hold characters of these classes in any Unicode version
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)]))
    own, odd = {}, set()
    for c in CLASSES:
        theirs = [where for _, where in Split(Regex(c + "+"), "removed", invert=True).pre_tokenize_str(text)]
        own[c] = _ranges([w for a, b in theirs for w in _unbroken(text, a, b)], text)
        ours = {m.start() for m in regex.finditer(c, text)}
        odd |= ours ^ {i for a, b in theirs for i in range(a, b)}
    return own, "".join(f"\\U{ord(text[i]):08x}" for i in sorted(odd))


def _unbroken(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """``text[a:b]`` cut where code points are left out."""
    cuts = [a, *(i for i in (0xD800, 0xD800 + 0x40000 - 0xE000) if a < i < b), b]
    return list(zip(cuts, cuts[1:]))


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte: printable Latin-1 characters
    stand for themselves, the other bytes get characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_spec(path: str) -> dict[str, Any]:
    """Plain description of a tokenizer file (a few MB at most)."""
    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    model, pre = doc["model"], doc["pre_tokenizer"]
    odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback",
                       "ignore_merges") if model.get(k)]
    if model["type"] != "BPE" or odd or doc["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary {odd}")
    for t in doc["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"{path}: added token {t['content']} has options that are not supported")
    of = byte_alphabet()
    to_bytes = lambda s: bytes(of[c] for c in s)
    ids = {t: i for t, i in model["vocab"].items() if not any(a["content"] == t for a in doc["added_tokens"])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    classes, odd = library_classes()
    return {
        "classes": classes, "odd": odd,
        "tokens": {i: to_bytes(t) for t, i in ids.items()},
        "merges": [(ids[a], ids[b], ids[a + b]) for a, b in merges],
        "added": {a["content"]: a["id"] for a in doc["added_tokens"]},
    }


class Vocabulary:
    def __init__(self, spec: dict[str, Any]):
        self.tokens: dict[int, bytes] = spec["tokens"]
        self.added: dict[str, int] = spec["added"]
        self.by_bytes = {b: i for i, b in self.tokens.items()}
        self.byte_ids = [self.by_bytes[bytes([b])] for b in range(256)]
        self.rank_of = {a << 20 | b: rank for rank, (a, b, _) in enumerate(spec["merges"])}.get
        self.made = [c for _, _, c in spec["merges"]]
        self._pieces = regex.compile(PATTERN).findall
        odd = spec["odd"]
        self._odd = regex.compile(f"[{odd}]").search if odd else None
        self._first_odd = chr(int(odd[2:10], 16)) if odd else ""
        letter, number, space = (spec["classes"][c] for c in CLASSES)
        self._exact = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
                                    .replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]")
                                    .replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")).findall
        self._added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of ordinary text, as the library cuts them."""
        if self._odd and text and max(text) >= self._first_odd and self._odd(text):
            return self._exact(text)
        return self._pieces(text)

    def parts(self, text: str) -> list[str]:
        """Ordinary text at even places, added tokens at odd ones."""
        return self._added.split(text) if any(a in text for a in self.added) else [text]

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: apply the lowest-ranked merge, leftmost
        first, until none applies (a heap over a linked list, so a very
        long pre-token takes n log n)."""
        from heapq import heapify, heappop, heappush

        ids = [self.byte_ids[b] for b in data]
        n = len(ids)
        if n <= 32:   # short: a list of the pairs' ranks is cheaper than a heap
            rank_of, made = self.rank_of, self.made
            ranks = [rank_of(a << 20 | b, NEVER) for a, b in zip(ids, ids[1:])]
            while ranks:
                rank = min(ranks)
                if rank == NEVER:
                    break
                i = ranks.index(rank)
                ids[i:i + 2] = [c] = [made[rank]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank_of(ids[i - 1] << 20 | c, NEVER)
                if i < len(ranks):
                    ranks[i] = rank_of(c << 20 | ids[i + 1], NEVER)
            return ids
        rank_of, made = self.rank_of, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (rank := rank_of(ids[i] << 20 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue        # one side has been merged since
            ids[i], ids[j] = c, _ = made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(c << 20 | ids[k])) is not None:
                    heappush(heap, (rank, i, c, ids[k]))
            h = before[i]
            if h >= 0 and (rank := rank_of(ids[h] << 20 | c)) is not None:
                heappush(heap, (rank, h, ids[h], c))
        return [t for t in ids if t >= 0]


_BUILT: dict[str, tuple[Any, Any]] = {}


def on_worker(kind: str, broadcast, build):
    """``build(broadcast.value)``, made once per worker process and broadcast.
    Only what comes from the last broadcast is kept, whatever its kind: a
    worker outlives many jobs, and what one stage has built would take room
    in all later ones."""
    value = broadcast.value
    if any(known is not value for known, _ in _BUILT.values()):
        _BUILT.clear()
        gc.collect()        # what was built may hold itself by its bound methods
    if kind not in _BUILT:
        _BUILT[kind] = (value, build(value))
    return _BUILT[kind][1]


def slices(batch, rows: int = 256):
    """A batch in small parts, so that only few texts are Python objects at
    a time."""
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


class Memo(dict):
    """Results by string, for at most ``2 * most`` short strings: when
    ``most`` are held they become the older half, from which a string that
    is asked for again comes back."""

    def __init__(self, fn, most: int = 160_000, longest: int = 40):
        super().__init__()
        self.fn, self.most, self.longest, self.older = fn, most, longest, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class _Irregular(Exception):
    """White space beside a space: words are no units of the pattern there."""


class Pieces:
    """Values of a text's pre-tokens, in order, gathered word by word.

    Where a space has no white space beside it, a pre-token ends before it,
    whatever surrounds it: no pre-token holds a space behind its first
    character.  So such a text is a first word and then words with a space
    before them, and the values of a word can be kept.  Other texts are cut
    by the pattern as a whole.
    """

    def __init__(self, vocab: Vocabulary, of_piece, gather):
        self.vocab, self.gather = vocab, gather
        self.of_piece, self.of_word = Memo(of_piece), Memo(self._word)

    def _by_pattern(self, text: str):
        return self.gather(map(self.of_piece.__getitem__, self.vocab.pieces(text)))

    def _word(self, word: str):
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Irregular
        if max(word) < "\u0250":       # below this, isalpha() is the pattern's letter class
            if word.isalpha():
                return self.gather([self.of_piece[" " + word]])
            if word[-1] in ".,;:!?" and word[:-1].isalpha():
                return self.gather([self.of_piece[" " + word[:-1]], self.of_piece[word[-1]]])
        return self._by_pattern(" " + word)

    def text(self, text: str):
        """``gather`` of the values of ordinary text."""
        first, *words = text.split(" ")
        if not words or not first or first[-1].isspace():
            return self._by_pattern(text)
        try:
            return self.gather([self._by_pattern(first), *map(self.of_word.__getitem__, words)])
        except _Irregular:
            return self._by_pattern(text)
