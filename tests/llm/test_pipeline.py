"""The pipeline against its stages done by hand."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from repolens.llm import exact_dedup, mixing, toxicity
from repolens.llm.q_mixing import BLOCK_ROWS, WEIGHTS
from repolens.llm.registry import table

from .test_duplicates import brute_near

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    scorer = toxicity.Scorer(model)
    rows = [r for r in docs.collect() if scorer.scores([r.text])[0] < 0.5]
    best = {}
    for r in rows:
        k = exact_dedup.normalise(r.text)
        if k not in best or best[k].doc_id < r.doc_id:
            best[k] = r
    rows = list(best.values())
    rows = [r for r, (d, _, c) in zip(rows, brute_near(rows, 3, 3)) if d == c]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in rows}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and len(got) == len(want)
    sha = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in rows}
    assert all(r.decoded_sha256 == sha[r.doc_id] and r.n_tokens == len(r.ids) for r in got)
    # the mixture: without its stage, or if a read disturbed it, the order is another one
    kept = docs.join(spark.createDataFrame([(i,) for i in want], "doc_id long"), "doc_id", "left_semi")
    mixed = mixing.mix(kept, WEIGHTS, BLOCK_ROWS).select("doc_id", "mix.*").collect()
    order = [r.doc_id for r in sorted(mixed, key=lambda r: (r.slot, r.place))]
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.mixed_file, r.mixed_row))] == order
    assert len({(r.mixed_file, r.mixed_row) for r in got}) == len(got)


def test_stages_return_the_columns_of_documents(spark, docs):
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = base
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == base.columns
    assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() == out.count()
