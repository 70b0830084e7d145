"""Quality from preference pairs.

Every text has a score, a weighted sum of what its characters, words and lines
look like. Weights come from pairs of labelled documents, a good one and a bad one: the good one
is preferred with the logistic probability of the difference of their scores (the model of
Bradley and Terry), and the loss of all pairs is minimised with a small ridge by Newton's steps.
All pairs of all labelled rows count. They are not listed: rows are counted by label and score in narrow bins, and what a row
meets in the other label follows from these counts, so a step takes two passes over the rows.
A score's cut is the quantile at which as large a share of the labelled
documents lies below as is labelled bad; the cut scores THRESHOLD.

NULL text counts as empty; a text without words has the features of nothing and a score
like others. Equal texts have equal scores, whatever else their rows hold. Labels other than 0 and 1
are left out; a repeated id enters as often as it repeats. Without both labels every text scores
alike, high if the label is 1. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm.shared import saved, widened

# Where rows are in memory, each meets so many of the other label.
PAIRS = 12
RIDGE = 1e-3
STEPS = 25
THRESHOLD = 0.3
# Bins of scores: as wide as this near their mean, and beyond FAR by the logarithm of the distance.
WIDTH = 1 / 16
FAR = 64
# An exact quantile is narrowed down to so many rows by ranges of so many bins.
FEW = 10_000
CUTS = 4_096

# What a byte is: lower case, upper case, digit, blank, line end, mark of a sentence, exclamation mark, other symbol, not ASCII.
KINDS = 9
_KIND = np.full(256, 7, np.uint8)
for _kind, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\r\x0b\x0c", b"\n", b".,;:'\"?()-", b"!")):
    _KIND[list(_bytes)] = _kind
_KIND[128:] = 8
_BLOCK = 1 << 20  # bytes of one text that are looked at together
FEATURES = 2 * (KINDS + 7)


@dataclass(frozen=True)
class Model:
    """Weights of the features, and the line from a text's score to its log odds."""

    weights: np.ndarray
    scale: float
    shift: float

    def __call__(self, features: np.ndarray) -> np.ndarray:
        odds = np.clip(self.scale * (features @ self.weights) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-odds))


def features(text: bytes | None) -> np.ndarray:
    """Shares of a text's bytes, words and lines, and their square roots, in which small shares stand out."""
    seen, ends, shouted = np.zeros(KINDS, np.int64), 0, 0
    n_words = again = apart = short = 0
    n_lines, lines_again, known = 0, 0, set()
    last: list[bytes] = []
    for part in _parts(text or b""):
        kind = _KIND[np.frombuffer(part, np.uint8)]
        seen += np.bincount(kind, minlength=KINDS)
        symbol, blank = kind >= 6, (kind == 3) | (kind == 4)
        ends += int((symbol[:-1] & (kind[:-1] < 8) & blank[1:]).sum())
        upper = kind == 1
        shouted += int((upper[1:] & upper[:-1]).sum())
        words = part.split()
        chain = last + words
        again += sum(map(eq, chain[len(last) :], chain[len(last) - 1 :])) if last else sum(map(eq, words[1:], words))
        apart += sum(map(eq, chain[2:], chain))
        short += sum(len(w) <= 3 for w in words)
        n_words += len(words)
        last = chain[-2:]
        for line in part.split(b"\n"):
            if line:
                name = hash(line)
                n_lines += 1
                lines_again += name in known
                known.add(name)
    n_bytes = max(1, int(seen.sum()))
    words_or_one = max(1, n_words)
    shares = [
        *(seen / n_bytes),
        ends / words_or_one,
        shouted / n_bytes,
        again / words_or_one,
        apart / words_or_one,
        short / words_or_one,
        lines_again / max(1, n_lines),
        min(1.0, (n_bytes - seen[3] - seen[4]) / words_or_one / 40),
    ]
    row = np.array(shares)
    return np.concatenate([row, np.sqrt(np.clip(row, 0, None))])


def _parts(text: bytes) -> Iterator[bytes]:
    """``text`` in blocks that end with a blank, or where a block has none, at its size."""
    at = 0
    while len(text) - at > _BLOCK:
        cut = max(text.rfind(b" ", at, at + _BLOCK), text.rfind(b"\n", at, at + _BLOCK)) + 1
        cut = cut if cut > at else at + _BLOCK
        yield text[at:cut]
        at = cut
    yield text[at:]


def train(rows: np.ndarray, labels: np.ndarray, bad_share: float | None = None, seed: int = 13) -> Model:
    """Fit to feature rows and labels; ``bad_share`` is label 0's share where the rows do not show it."""
    labels = np.asarray(labels, np.int64)
    good, bad = rows[labels == 1], rows[labels == 0]
    if not len(good) or not len(bad):
        return Model(np.zeros(FEATURES), 0.0, 2.0 if len(good) else -2.0)
    spread = rows.std(0)
    spread = np.where(spread > 1e-9, spread, np.inf)  # what never varies says nothing
    random = np.random.default_rng(seed)
    pairs = [(np.repeat(np.arange(len(good)), PAIRS), random.integers(0, len(bad), len(good) * PAIRS))]
    pairs.append((random.integers(0, len(good), len(bad) * PAIRS), np.repeat(np.arange(len(bad)), PAIRS)))
    share = [0.5 / len(p[0]) for p in pairs]
    weights = np.zeros(FEATURES)
    for _ in range(STEPS):
        slope, curve = RIDGE * weights, RIDGE * np.eye(FEATURES)
        for (preferred, other), each in zip(pairs, share):
            difference = (good[preferred] - bad[other]) / spread
            chance = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))  # that the bad one is preferred
            slope -= each * difference.T @ chance
            curve += each * (difference * (chance * (1 - chance))[:, None]).T @ difference
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    weights = weights / spread
    return _cut(weights, good @ weights, bad @ weights, bad_share)


def _cut(weights: np.ndarray, good: np.ndarray, bad: np.ndarray, bad_share: float | None) -> Model:
    """Put the quantile of the labelled scores at THRESHOLD, half of the way to the next score."""
    if bad_share is None:
        bad_share = len(bad) / (len(bad) + len(good))
    scores = np.concatenate([bad, good])
    order = np.argsort(scores, kind="stable")
    weigh = np.concatenate([np.full(len(bad), bad_share / len(bad)), np.full(len(good), (1 - bad_share) / len(good))])
    below = np.cumsum(weigh[order])
    at = int(np.searchsorted(below, bad_share * (1 - 1e-9)))
    ranked = scores[order]
    cut = (ranked[at] + ranked[min(at + 1, len(ranked) - 1)]) / 2
    scale = 1 / max(1e-9, abs(float(np.median(good)) - float(np.median(bad))) / 8)
    return Model(weights, scale, float(np.log(THRESHOLD / (1 - THRESHOLD)) - scale * cut))


def fit(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> Model:
    """A model from all labelled rows of ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``).

    Rows stay on the executors; counts and sums by label and bin of scores reach the driver. With ``sample`` at most so many
    rows of each label are used, those with the smallest hash of their id, and each meets PAIRS of the other label.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    counts = dict(known.groupBy("quality").count().collect())
    total = sum(counts.values())
    bad_share = counts.get(0, 0) / total if total else None
    if sample is None:
        return _fit_whole(_labelled(docs, known), bad_share)
    rows, marks = [np.zeros((0, FEATURES))], []
    for label in (0, 1):
        picked = known.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        made = _labelled(docs, picked).select("features")
        # Repeated ids could make them more; which are left out depends on their features alone.
        made = [r["features"] for r in made.orderBy("features").limit(sample).collect()]
        if made:
            rows.append(np.array(made))
            marks += [label] * len(made)
    return train(np.concatenate(rows), np.array(marks, np.int64), bad_share)


def _labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``quality`` and ``features`` of all labelled rows, as a table; features come before the join, so that it moves no text."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kinds = T.StructType([docs.schema["doc_id"], T.StructField("features", T.ArrayType(T.DoubleType()))])
    made = texts.mapInArrow(_features, kinds).join(known, "doc_id")
    return saved(made.select("quality", "features"), "quality-features")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()).tolist() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Labels and feature rows of a batch."""
    return batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(-1, FEATURES)


def _fit_whole(rows: DataFrame, bad_share: float | None) -> Model:
    """Newton's steps on the mean loss of all pairs of a good and a bad row of ``rows``."""
    n, middle, spread = _moments(rows)
    if not n[0] or not n[1]:
        return Model(np.zeros(FEATURES), 0.0, 2.0 if n[1] else -2.0)
    weights = step = np.zeros(FEATURES)
    least = np.inf
    for _ in range(2 * STEPS):
        bins = _binned(rows, weights, middle, spread)
        loss, cross, tables = _met(bins)
        loss += RIDGE / 2 * float(weights @ weights)
        if loss > least + 1e-9:  # too far: half of the step
            step = step / 2
            weights = weights - step
            if np.abs(step).max() < 1e-5:
                break
            continue
        least = loss
        slope, curve = _derived(rows, weights, middle, spread, tables, n)
        slope = slope + RIDGE * weights
        step = -np.linalg.solve(curve - cross - cross.T + RIDGE * np.eye(FEATURES), slope)
        if np.abs(step).max() < 1e-5:
            break
        weights = weights + step
    weights = weights / spread
    return _line(rows, weights, n, bad_share)


def _moments(rows: DataFrame) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Rows of either label, and the mean and spread of each feature over both."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(2 + FEATURES)
        for batch in batches:
            labels, x = _arrays(batch)
            out += np.concatenate([np.bincount(labels, minlength=2), x.sum(0)])
        yield _one_row(out)

    found = _summed(rows, sums, 2 + FEATURES)
    n = [int(v) for v in found[:2]]
    middle = found[2:] / max(1, sum(n))

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(FEATURES)
        for batch in batches:
            out += ((_arrays(batch)[1] - middle) ** 2).sum(0)
        yield _one_row(out)

    spread = np.sqrt(_summed(rows, squares, FEATURES) / max(1, sum(n)))
    return n, middle, np.where(spread > 1e-9, spread, np.inf)  # what never varies says nothing


def _one_row(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tolist()], pa.list_(pa.float64()))], names=["sums"])


def _summed(rows: DataFrame, run: Callable, size: int) -> np.ndarray:
    """The sum of the one row of ``size`` numbers that each task makes."""
    made = rows.mapInArrow(run, "sums array<double>").collect()
    return np.sum([np.zeros(size), *(r["sums"] for r in made)], axis=0)


def _bin(scores: np.ndarray) -> np.ndarray:
    far = np.maximum(np.abs(scores), FAR)
    return np.floor(np.where(far > FAR, np.sign(scores) * FAR * (1 + np.log(far / FAR)), scores) / WIDTH).astype(np.int64)


def _binned(rows: DataFrame, weights: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> dict[int, np.ndarray]:
    """For either label a line for each bin of scores that has rows: their number, mean score, and sum of features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, x = _arrays(batch)
            x = (x - middle) / spread
            scores = x @ weights
            keys, at = np.unique(np.stack([labels, _bin(scores)], 1), axis=0, return_inverse=True)
            sums = np.zeros((len(keys), 2 + FEATURES))
            np.add.at(sums, at.ravel(), np.column_stack([np.ones(len(x)), scores, x]))
            columns = [pa.array(keys[:, 0], pa.int32()), pa.array(keys[:, 1], pa.int64()), pa.array(sums.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["quality", "bin", "sums"])

    each = [F.sum(F.col("sums")[i]) for i in range(2 + FEATURES)]
    made = rows.mapInArrow(run, "quality int, bin long, sums array<double>")
    found = made.groupBy("quality", "bin").agg(F.array(*each).alias("sums")).orderBy("quality", "bin").collect()
    bins = {label: np.array([r["sums"] for r in found if r["quality"] == label]) for label in (0, 1)}
    for b in bins.values():
        b[:, 1] /= b[:, 0]
    return bins


def _met(bins: dict[int, np.ndarray]) -> tuple[float, np.ndarray, dict[int, np.ndarray]]:
    """The mean loss of all pairs, the mixed part of its curvature, and for either label by score: what a row meets on
    average in the other label, as the chance that the bad one is preferred, and that chance's variance."""
    bad, good = bins[0], bins[1]
    share_bad, share_good = bad[:, 0] / bad[:, 0].sum(), good[:, 0] / good[:, 0].sum()
    loss, cross = 0.0, np.zeros((FEATURES, FEATURES))
    of_good, of_bad = np.zeros((len(good), 2)), np.zeros((len(bad), 2))
    for at in range(0, len(good), 256):
        own = slice(at, at + 256)
        ahead = np.clip(bad[:, 1] - good[own, 1][:, None], -700, 700)
        chance = 1 / (1 + np.exp(-ahead))
        both = chance * (1 - chance)
        loss += float(share_good[own] @ np.logaddexp(0, ahead) @ share_bad)
        of_good[own] = np.column_stack([chance @ share_bad, both @ share_bad])
        of_bad += np.column_stack([share_good[own] @ chance, share_good[own] @ both])
        cross += good[own, 2:].T @ (both @ bad[:, 2:])
    cross /= good[:, 0].sum() * bad[:, 0].sum()
    return loss, cross, {0: np.column_stack([bad[:, 1], of_bad]), 1: np.column_stack([good[:, 1], of_good])}


def _derived(
    rows: DataFrame, weights: np.ndarray, middle: np.ndarray, spread: np.ndarray, tables: dict[int, np.ndarray], n: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """The slope of the mean loss, and its curvature without the mixed part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, curve = np.zeros(FEATURES), np.zeros((FEATURES, FEATURES))
        for batch in batches:
            labels, x = _arrays(batch)
            x = (x - middle) / spread
            for label, sign in ((0, 1), (1, -1)):
                own = x[labels == label]
                scores, table = own @ weights, tables[label]
                slope += sign / n[label] * (np.interp(scores, table[:, 0], table[:, 1]) @ own)
                curve += (own * np.interp(scores, table[:, 0], table[:, 2])[:, None]).T @ own / n[label]
        yield _one_row(np.concatenate([slope, curve.ravel()]))

    found = _summed(rows, run, FEATURES * (1 + FEATURES))
    return found[:FEATURES], found[FEATURES:].reshape(FEATURES, FEATURES)


def _line(rows: DataFrame, weights: np.ndarray, n: list[int], bad_share: float | None) -> Model:
    """As ``_cut``, with exact quantiles of the scores of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _arrays(batch)[1] @ weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["quality", "score"])

    scored = saved(rows.mapInArrow(run, "quality int, score double"), "quality-scores")
    if bad_share is None:
        bad_share = n[0] / sum(n)
    cut = sum(_quantile(scored, (bad_share / n[0], (1 - bad_share) / n[1]), bad_share)) / 2
    medians = []
    for label in (0, 1):
        low, high = _quantile(scored.filter(F.col("quality") == label), (1 / n[label], 1 / n[label]), 0.5)
        medians.append(low if n[label] % 2 else (low + high) / 2)
    scale = 1 / max(1e-9, abs(medians[1] - medians[0]) / 8)
    return Model(weights, scale, float(np.log(THRESHOLD / (1 - THRESHOLD)) - scale * cut))


def _quantile(scored: DataFrame, weigh: tuple[float, float], share: float) -> tuple[float, float]:
    """The least score at which rows weigh ``share`` together, each as ``weigh`` says for its label, and the next row's score."""
    wanted = share * (1 - 1e-9)
    below = np.zeros(2)  # rows of either label left of the range
    found = scored.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count("*").alias("n")).first()
    low, high, n, after = found["low"], found["high"], found["n"], found["high"]
    while n > FEW and low < high:
        at = F.least(F.floor((F.col("score") - low) / (high - low) * CUTS), F.lit(CUTS - 1))
        bad = F.count_if(F.col("quality") == 0)
        inside = scored.filter(F.col("score").between(low, high)).groupBy(at.alias("at"))
        sums = inside.agg(bad.alias("bad"), F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        parts = sums.orderBy("at").collect()
        for i, part in enumerate(parts):
            counts = np.array([part["bad"], part["n"] - part["bad"]])
            if (below + counts) @ weigh >= wanted or i == len(parts) - 1:
                break
            below = below + counts
        if i < len(parts) - 1:
            after = parts[i + 1]["low"]
        low, high, n = part["low"], part["high"], part["n"]
    if low == high:
        tied = scored.filter(F.col("score") == low).groupBy().agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count("*").alias("n")).first()
        whole = below + np.array([tied["bad"], tied["n"] - tied["bad"]])
        last = weigh[0] if tied["bad"] == tied["n"] else weigh[1]
        return low, low if whole @ weigh - last >= wanted else after
    rows = scored.filter(F.col("score").between(low, high)).orderBy("score", "quality").collect()
    upto = below @ weigh + np.cumsum([weigh[r["quality"]] for r in rows])
    at = min(int(np.searchsorted(upto, wanted)), len(rows) - 1)
    return rows[at]["score"], rows[at + 1]["score"] if at + 1 < len(rows) else after


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) from ``text``.

    A column named ``score`` is replaced; all others stay.
    """
    kept = docs.drop("score")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [float(model(features(None if (t := v.as_py()) is None else t.encode("utf-8", "surrogatepass")))) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, "score"])

    return kept.mapInArrow(run, widened(kept, score="double"))
