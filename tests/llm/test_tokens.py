"""Token counts, encoding and decoding against the tokenizers library."""

import hashlib
import random
import weakref

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from repolens.llm import bpe_dp, bpe_vocab, token_count
from repolens.llm.bpe_vocab import Vocabulary, load_spec

from .conftest import ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    r = random.Random(3)
    out = ["a<|endoftext|>b  <|endoftext|>", " " * 500 + "x", "ab" * 5000, "  x　 \x1c\x1d\x85y", "don't I'LL we've", "a \x1c b",
           "a\x85 b c", " a b", "a b ", "", "word\n\nword  two"]
    pools = [range(32, 127), range(160, 0x250), range(0x2000, 0x2100), range(0x1f300, 0x1f6ff), [32], [10]]
    return out + ["".join(chr(r.choice(r.choice(pools))) for _ in range(r.randrange(1, 120))) for _ in range(400)]


def test_whole_tokens_are_proved(library):
    spec = load_spec(PATH)
    whole = token_count.whole_tokens(Vocabulary(spec))
    for s in random.Random(1).sample(whole, 2000):
        assert len(library.encode(s, add_special_tokens=False).ids) == 1


def test_counts_ids_and_decoding_equal_the_library(library):
    spec = load_spec(PATH)
    counter = token_count.Counter(spec | {"whole": token_count.whole_tokens(Vocabulary(spec))})
    encoder, decoder = bpe_dp.Encoder(spec), bpe_dp.Decoder(spec)
    import numpy as np
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(ids)
        assert encoder.encode(text) == ids
        assert decoder.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False) == text


def test_every_character_is_classed_as_the_library_does(library):
    """All code points beside a contraction, between letters and digits, after
    a space, and all of them under the pattern of the library's classes."""
    spec = load_spec(PATH)
    vocab = Vocabulary(spec)
    split = library.pre_tokenizer.pre_tokenize_str
    cut = lambda text: [text[a:b] for _, (a, b) in split(text)]
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    odd = sorted({c for c in every if vocab._odd(c)})
    assert len(odd) > 1000          # the installed versions differ; else the next lines test nothing new
    r = random.Random(4)
    for c in r.sample(odd, 400) + r.sample(every, 400):
        for text in (f"{c}'s", f"a{c}b", f" {c}", f"a's{c}'ll 1{c}2 {c} x", f"{c} {c}"):
            assert vocab.pieces(text) == vocab._exact(text) == cut(text)
    # every code point that is not the same kind of other character in both, and one in eight of the rest
    plain = regex.compile(r"[^\s\p{L}\p{N}]").match
    known = [c for i, c in enumerate(every) if i % 8 == 0 or not plain(c)]
    for a in range(0, len(known), 40):
        text = "".join(f"a{c}'s 1{c}" for c in known[a:a + 40])
        assert vocab.pieces(text) == cut(text)


def test_ids_of_characters_of_other_unicode_versions(library):
    spec = load_spec(PATH)
    counter = token_count.Counter(spec | {"whole": token_count.whole_tokens(Vocabulary(spec))})
    encoder, is_odd = bpe_dp.Encoder(spec), Vocabulary(spec)._odd
    odd = [c for c in map(chr, range(0x20000)) if is_odd(c)]
    r = random.Random(5)
    for _ in range(400):
        text = "".join(r.choice([r.choice(odd), r.choice("ab1 '.\n"), "'s", " the", "é"]) for _ in range(r.randrange(1, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids and counter.count(text) == len(ids)


def test_compatible_pairs_are_those_that_merge_to_themselves():
    spec = load_spec(PATH)
    encoder, vocab = bpe_dp.Encoder(spec), Vocabulary(spec)
    r = random.Random(2)
    for _ in range(3000):
        a, b = r.randrange(50_256), r.randrange(3000)
        if vocab.merge(vocab.tokens[a]) == [a] and vocab.merge(vocab.tokens[b]) == [b]:
            assert encoder.compatible(a, b) == (vocab.merge(vocab.tokens[a] + vocab.tokens[b]) == [a, b])


def test_operators_on_odd_rows(docs, no_docs, library):
    want = sorted(((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in ROWS), key=str)
    counts = token_count.count_tokens(docs, PATH, 10).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in counts), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 10) for r in counts)
    done = bpe_dp.round_trip(docs, PATH).collect()
    assert sorted(((r.doc_id, len(r.ids)) for r in done), key=str) == want
    assert sorted(r.text for r in done) == sorted(t or "" for _, t, *_ in ROWS)
    again = bpe_dp.decode(bpe_dp.encode(docs, PATH), PATH).collect()
    assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in again) == sorted(
        hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in ROWS)
    assert token_count.count_tokens(no_docs, PATH, 10).count() == bpe_dp.round_trip(no_docs, PATH).count() == 0


def test_worker_keeps_what_the_last_broadcast_built(monkeypatch):
    class Sent:
        def __init__(self, value):
            self.value = value

    class Table:
        def __init__(self, value):
            self.value, self.own = value, self.look      # holds itself, as Pieces and Memo do

        def look(self):
            return self.value

    monkeypatch.setattr(bpe_vocab, "_BUILT", {})
    one, two = Sent(["spec"]), Sent(["model"])
    encoder, decoder = (bpe_vocab.on_worker(k, one, Table) for k in ("encode", "decode"))
    assert bpe_vocab.on_worker("encode", one, Table) is encoder and bpe_vocab.on_worker("decode", one, Table) is decoder
    gone = [weakref.ref(encoder), weakref.ref(decoder)]
    del encoder, decoder
    scorer = bpe_vocab.on_worker("toxicity", two, Table)
    assert scorer.value is two.value and [r() for r in gone] == [None, None]
    assert bpe_vocab.on_worker("encode", one, Table).value is one.value and list(bpe_vocab._BUILT) == ["encode"]
