import math
import random

import numpy as np
import pytest

from cellweave.llm import queries, toxicity

BAD = ["stupid", "worthless", "pathetic", "disgusting"]
GOOD = "the and of river mountain table window garden yellow music paper simple walking holiday kitchen".split()


def made(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(GOOD) + rng.choice(["", "s", "ing", "er"]) for _ in range(rng.randint(20, 200))]
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(words))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*made(400, 1))


def test_held_out_accuracy(model):
    texts, labels = made(200, 2)
    scorer = toxicity.Scorer(model)
    assert np.mean([(scorer(t) >= 0.5) == y for t, y in zip(texts, labels)]) > 0.98


def test_misspellings_and_long_texts(model):
    scorer = toxicity.Scorer(model)
    assert scorer("the stuupid and pathetiic yellow river of disgustingg paper") > 0.5
    clean = " ".join(GOOD * 3000)
    assert scorer(clean) < 0.5 < scorer(clean + " stupid worthless pathetic")
    assert all(scorer(t) < 0.5 for t in (None, "", "!!! ...", "river"))


def plain_score(model, text):
    """The weighted average of all distinct words, word by word."""
    words = list(dict.fromkeys(toxicity.WORD.findall((text or "").lower())))
    if not words:
        return 1 / (1 + math.exp(-(model.bias + toxicity.NO_WORDS)))
    scores = []
    for word in words:
        rows = np.concatenate([r for r, _ in toxicity.grams([word])])
        scores.append(sum(float(model.weight[r]) for r in rows) / len(rows))
    weights = [math.exp(toxicity.ATTENTION * x) for x in scores]
    logit = model.bias + sum(w * x for w, x in zip(weights, scores)) / sum(weights)
    return 1 / (1 + math.exp(-logit))


def test_scores_equal_a_plain_average(model):
    scorer = toxicity.Scorer(model)
    for text in [*made(40, 5)[0], None, "", "a", "stupid", " ".join(f"w{i}" for i in range(500)), "é" * 300]:
        assert scorer(text) == pytest.approx(plain_score(model, text), abs=1e-6)


def test_more_words_of_the_same_kind_do_not_move_a_score():
    """Texts of very many distinct words, none of which training has seen."""
    rng = random.Random(8)
    parts = ["an", "er", "th", "ou", "in", "re", "ly", "st", "ea", "le", "on", "ti"]

    def text(n):
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 6))) for _ in range(n))

    texts, labels = [], []
    for i in range(600):
        words = text(rng.randint(20, 400)).split()
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(words))
    scorer = toxicity.Scorer(toxicity.train(texts, np.array(labels)))
    long = [text(n) for n in (300, 3_000, 10_000, 30_000, 30_000)]
    assert len(set(long[-1].split())) > 15_000
    scores = [scorer(t) for t in long]
    assert max(scores) < 0.5 and max(scores) - min(scores) < 0.3
    assert all(scorer(t + " " + " ".join(BAD * 2)) > s + 0.1 for t, s in zip(long, scores))
    assert scorer(long[1] + " " + " ".join(BAD)) > 0.5


def test_one_class_only():
    assert toxicity.Scorer(toxicity.train(["a"], np.array([0])))("a") < 0.5
    assert toxicity.Scorer(toxicity.train([], np.array([], int)))("a") < 0.5
    assert toxicity.Scorer(toxicity.train(["a", ""], np.array([1, 1])))("a") > 0.5


def test_spark_scores_equal_plain_ones(spark, model):
    df = spark.createDataFrame([(1, None, 9.0), (1, "stupid worthless", 9.0), (2, "", 9.0), (2, "x" * 50_000, None)], "doc_id long, text string, score double")
    scorer = toxicity.Scorer(model)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == 4
    for r in rows:
        assert r["score"] == pytest.approx(scorer(r["text"]))
    assert toxicity.score(df.limit(0), model).count() == 0


def test_fit_takes_bounded_labelled_rows(spark):
    rows = [(i, t, int(y), "x") for i, (t, y) in enumerate(zip(*made(80, 3)))] + [(900, "stupid", None, "x"), (None, None, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    docs, labels = df.drop("toxic"), df.drop("text")
    assert toxicity.Scorer(toxicity.fit(docs, labels, sample=30))("stupid worthless pathetic") > 0.5
    assert toxicity.Scorer(toxicity.fit(docs, labels.limit(0)))("stupid") < 0.5


def test_query(spark, given):
    folder = "/root/testdata/sf0.01"
    rows = queries.queries()["op7_toxicity"](spark, folder).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.9
