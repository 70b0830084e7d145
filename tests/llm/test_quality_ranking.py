import random

import numpy as np
import pytest

from cellweave.llm import quality_ranking as quality
from cellweave.llm import queries

WORDS = "the and of river mountain table window garden yellow music paper simple walking holiday kitchen über señor".split()


def prose(rng, n):
    words = [rng.choice(WORDS) for _ in range(n)]
    for i in range(0, n, 9):
        words[i] = words[i].capitalize()
        words[i - 1] += rng.choice([".", ".\n", ",", "?"])
    return " ".join(words)


def junk(rng, n):
    kind, text = rng.randrange(4), prose(rng, n)
    if kind == 0:
        return " ".join(w + rng.choice(["###", "&&&", "$$$"]) for w in text.split(" "))
    if kind == 1:
        return text.upper().replace(" ", "!! ")
    if kind == 2:
        return " | ".join(text.split())
    return " ".join(w for w in text.split()[: n // 10] for _ in range(10))


def made(n, seed, low=20, high=300):
    rng = random.Random(seed)
    labels = np.array([int(i % 5 > 0) for i in range(n)])
    return [(prose if y else junk)(rng, rng.randint(low, high)) for y in labels], labels


def rows_of(texts):
    return np.array([quality.features(None if t is None else t.encode()) for t in texts])


@pytest.fixture(scope="module")
def model():
    texts, labels = made(500, 1)
    return quality.train(rows_of(texts), labels)


def test_held_out_accuracy(model):
    texts, labels = made(300, 2)
    scores = model(rows_of(texts))
    assert np.mean((scores >= quality.THRESHOLD) == labels) > 0.98
    assert scores[labels == 1].min() > scores[labels == 0].max()


def test_length_and_order_do_not_decide(model):
    for seed in range(5):
        texts, labels = made(10, 10 + seed, 3000, 30_000)
        assert ((model(rows_of(texts)) >= quality.THRESHOLD) == labels).all()


def test_preference_probability_is_fitted(model):
    """The gradient of the pairs' logistic loss vanishes: a plain descent from the fit finds nothing better."""
    texts, labels = made(60, 3, 5, 20)
    rows = rows_of(texts)
    fitted = quality.train(rows, labels)
    good, bad = rows[labels == 1], rows[labels == 0]
    spread = rows.std(0)
    spread = np.where(spread > 1e-9, spread, np.inf)
    random_ = np.random.default_rng(13)
    pairs = [(np.repeat(np.arange(len(good)), quality.PAIRS), random_.integers(0, len(bad), len(good) * quality.PAIRS))]
    pairs.append((random_.integers(0, len(good), len(bad) * quality.PAIRS), np.repeat(np.arange(len(bad)), quality.PAIRS)))

    def loss(weights):
        total = quality.RIDGE / 2 * (weights**2).sum()
        for g, b in pairs:
            total += 0.5 * np.mean([np.log1p(np.exp(-((good[i] - bad[j]) / spread) @ weights)) for i, j in zip(g, b)])
        return total

    weights = np.where(np.isfinite(spread), fitted.weights * np.where(np.isfinite(spread), spread, 0), 0)
    least = loss(weights)
    rng = np.random.default_rng(1)
    assert all(loss(weights + rng.normal(0, 0.05, len(weights))) > least for _ in range(30))


def test_cut_is_the_quantile_of_the_bad_share():
    good, bad = np.linspace(0, 10, 101), np.linspace(-5, 2, 50)
    fitted = quality._cut(np.zeros(quality.FEATURES), good, bad, 0.25)
    at = (np.log(0.3 / 0.7) - fitted.shift) / fitted.scale
    below = 0.25 * (bad < at).mean() + 0.75 * (good < at).mean()
    assert below == pytest.approx(0.25, abs=0.02)


def test_odd_texts(model):
    assert np.isfinite(model(rows_of([None, "", " ", "\n", "!", "x" * 5_000_000, "é" * 3_000_000, "a b " * 900_000]))).all()
    a, b = rows_of([None, ""])
    assert (a == b).all()
    whole = quality.features(("word word other. " * 200_000).encode())
    assert whole[11] == pytest.approx(1 / 3, abs=1e-4) and whole[12] == pytest.approx(1 / 3, abs=1e-4)


def test_one_label_only():
    for label, high in ((1, True), (0, False)):
        one = quality.train(rows_of(["a", "b"]), np.array([label, label]))
        assert ((one(rows_of(["a", None])) >= quality.THRESHOLD) == high).all()
    assert quality.train(np.zeros((0, quality.FEATURES)), np.zeros(0, int))(rows_of([""])) < quality.THRESHOLD


def test_spark_scores_equal_plain_ones(spark, model):
    df = spark.createDataFrame([(1, None, 9.0), (1, "Some words.", 9.0), (2, "", 9.0), (2, "x" * 50_000, None)], "doc_id long, text string, score double")
    rows = quality.score(df, model).collect()
    assert len(rows) == 4
    for r in rows:
        assert r["score"] == pytest.approx(float(model(rows_of([r["text"]]))[0]))
    assert quality.score(df.limit(0), model).count() == 0


def test_fit_takes_bounded_labelled_rows(spark):
    texts, labels = made(200, 4)
    rows = [(i, t, int(y), "x") for i, (t, y) in enumerate(zip(texts, labels))] + [(900, "odd", None, "x"), (None, None, 1, "x"), (3, texts[3], int(labels[3]), "x"), (901, "odd", 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, score string")
    docs, marks = df.drop("quality"), df.drop("text")
    fitted = quality.fit(docs, marks, sample=30)
    texts, labels = made(50, 5)
    assert np.mean((fitted(rows_of(texts)) >= quality.THRESHOLD) == labels) > 0.9
    assert quality.fit(docs, marks.limit(0))(rows_of(["x"])) < quality.THRESHOLD


def test_fit_takes_all_pairs_of_all_labelled_rows(spark):
    """With more than 4,000 good rows each counts: no descent from the fit betters all pairs, and the cut leaves as many below as are bad."""
    texts, labels = made(6000, 6, 3, 12)
    labels ^= np.random.default_rng(6).random(len(labels)) < 0.1  # so that the labels' scores overlap
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)], "doc_id long, quality int")
    fitted, rows = quality.fit(docs, marks), rows_of(texts)
    scores = fitted(rows)
    assert (scores < quality.THRESHOLD).sum() == (labels == 0).sum()
    spread = rows.std(0)
    spread = np.where(spread > 1e-9, spread, np.inf)
    good, bad = rows[labels == 1] / spread, rows[labels == 0] / spread
    weights = np.where(np.isfinite(spread), fitted.weights * np.where(np.isfinite(spread), spread, 0), 0)
    chance = 1 / (1 + np.exp((good @ weights)[:, None] - bad @ weights))
    slope = quality.RIDGE * weights + (chance.mean(0) @ bad) / len(bad) - (chance.mean(1) @ good) / len(good)
    assert np.abs(slope).max() < 2e-4


def test_quantiles_of_many_rows_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 3)
    monkeypatch.setattr(quality, "CUTS", 4)
    rng = random.Random(5)
    for values in ([rng.gauss(0, 1) for _ in range(200)], [rng.randrange(4) * 1.0 for _ in range(50)], [7.0] * 9, [1.0, 1e9, 2.0, 2.0, 3.0]):
        ranked = sorted(values)
        df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "quality int, score double")
        for share in (0.1, 0.5, 1.0):
            at = int(np.searchsorted(np.arange(1, len(ranked) + 1) / len(ranked), share * (1 - 1e-9)))
            each = 1 / len(ranked)
            assert quality._quantile(df, (each, each), share) == (ranked[at], ranked[min(at + 1, len(ranked) - 1)])


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.queries()["op13_quality_ranking"](spark, folder).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.97
