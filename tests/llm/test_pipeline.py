import re

import pytest
import sentencepiece

import corpus_pipeline
from cellweave.llm import queries, toxicity
import test_bag_minhash as bags
import test_decontaminate as checks


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, folder), "t")
        assert docs.dtypes == kept[0].dtypes
        kept.append(docs)
    return [[r.asDict() for r in d.collect()] for d in kept]


def test_every_stage_against_brute_force(spark, folder, stages):
    given, mild, single, clean, safe = stages
    ids = lambda rows: {r["doc_id"] for r in rows}
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(~queries.held_out(5, 0))
    scorer = toxicity.Scorer(toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), labels))
    assert ids(mild) == {r["doc_id"] for r in given if scorer(r["text"]) < 0.5}
    assert ids(single) == {c for _, c in bags.plain([(r["doc_id"], r["text"]) for r in mild])}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    marked = {d for d, _, hit, _ in checks.plain([(r["doc_id"], r["text"]) for r in single], items) if hit}
    assert ids(clean) == ids(single) - marked
    assert ids(safe) == ids(clean)
    before = {r["doc_id"]: r for r in clean}
    for r in safe:
        old = before[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        if r["text"] != old["text"]:
            assert re.search(r"\[(assign|access|hex|github|slack|jwt|pem)\]", r["text"])
        else:
            assert r == old


def test_run(spark, folder, stages):
    rows = corpus_pipeline.run(spark, folder).collect()
    theirs = sentencepiece.SentencePieceProcessor(model_file=f"{queries.TOKENIZERS}/piece_bpe_32k.model")
    texts = {r["doc_id"]: r["text"] for r in stages[-1]}
    assert {r["doc_id"] for r in rows} == set(texts) and all(r["round_trip"] for r in rows)
    assert all(r["ids"] == theirs.encode(texts[r["doc_id"]]) for r in rows)


def test_empty(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
