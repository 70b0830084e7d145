"""Toxicity from subword bags.

A word is the bag of its character n-grams (and itself), hashed to a fixed
number of embedding rows; a document is the average of all its distinct words' averages,
and a linear softmax over the average gives the two classes. Words weigh in the average by the
exponential of their own log odds, as in attention: a few toxic words in a long text are not
averaged away, and as weights are shares of the whole, more words of the same kind do not move
the average. Embeddings and softmax are trained together in numpy; an epoch draws some words
of each document by their weights so far. As n-grams carry the weight, unseen
misspellings of a word share most of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import widened

WORD = re.compile(r"[^\W_]+")
ROW_BITS, DIM = 18, 8
ROWS = 1 << ROW_BITS
NGRAMS = (3, 4, 5, 6)
# How fast a word's weight in the average grows with its log odds; words drawn of a document in an epoch.
ATTENTION, DRAWN = 1.0, 12
# The classifier is fitted on at most so many labelled rows of either class, those with the smallest hash of their id.
SAMPLE = 2_500
EPOCHS, BATCH, RATE = 8, 64, 0.1
CACHE = 400_000
BLOCK = 20_000  # words whose n-grams are made together
# The log odds of a text without words, before the bias.
NO_WORDS = -4.0


@dataclass(frozen=True)
class Model:
    """What scoring needs of the trained embeddings: each row's share in the log odds, and the bias."""

    weight: np.ndarray
    bias: float


def grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed rows and the word of each, for the n-grams of ``<word>`` of every length, then for whole words."""
    if not words:
        return
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    begins = np.cumsum(lengths) - lengths
    mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    rolled = mixed
    for n in range(2, max(NGRAMS) + 1):
        rolled = rolled[:-1] * np.uint64(0xD6E8FEB86659FD93) + mixed[n - 1 :]
        if n in NGRAMS:
            inside = owner[: len(rolled)] == owner[n - 1 :]
            yield _row(rolled[inside]), owner[: len(rolled)][inside]
    powers = np.uint64(0xFF51AFD7ED558CCD) ** (np.arange(len(code)) - begins[owner]).astype(np.uint64)
    yield _row(np.add.reduceat(mixed * powers, begins)), np.arange(len(words))


def _row(hashes: np.ndarray) -> np.ndarray:
    spread = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (spread >> np.uint64(64 - ROW_BITS)).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    """The distinct words of ``text`` in lower case, in order of their first place: repeating one word says nothing new."""
    return list(dict.fromkeys(WORD.findall((text or "").lower())))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit embeddings and softmax. Without both classes, every text gets the same low or high score."""
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        return Model(np.zeros(ROWS, np.float32), 4.0 if share > 0.5 else -4.0)
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64) for t in texts]
    flat, bounds = _rows_of(list(vocabulary))
    sizes = np.diff(bounds)
    random = np.random.default_rng(seed)
    embed = random.normal(0, 0.1, (ROWS, DIM)).astype(np.float32)
    soft = random.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    # The first dimension begins with what single rows tell, so that the first bags are well chosen.
    embed[:, 0] = _log_odds(docs, labels, flat, bounds)
    soft[0] = -1, 1
    gained = np.full((ROWS, 1), 1e-6, np.float32)  # Adagrad, a step size per row
    soft_gained = np.full(soft.shape, 1e-6, np.float32)
    filled = np.array([i for i, d in enumerate(docs) if len(d)], np.int64)
    positive = labels[filled] == 1
    weigh = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())) * len(filled)
    for epoch in range(EPOCHS):
        step = RATE * (1 - epoch / EPOCHS)
        word_score = _word_scores(flat, bounds, embed @ (soft[:, 1] - soft[:, 0]))
        # Of each document words by their weights; of clean ones any others, too, as none of them is toxic.
        picks = [(random.choice(docs[d], DRAWN, p=attention(word_score[docs[d]])), labels[d], weigh[i]) for i, d in enumerate(filled)]
        picks += [(random.choice(docs[d], DRAWN), 0, weigh[i]) for i, d in enumerate(filled) if not positive[i]]
        for chosen in np.array_split(random.permutation(len(picks)), -(-len(picks) // BATCH)):
            part = [picks[k] for k in chosen]
            words = [p[0] for p in part]
            counts = np.array([len(w) for w in words])
            word = np.concatenate(words)
            bag = np.repeat(np.arange(len(part)), counts)
            n = sizes[word]
            at = np.repeat(bounds[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            ids = flat[at]
            share = (1 / np.repeat(n * counts[bag], n)).astype(np.float32)
            of = np.repeat(bag, n)
            starts = np.searchsorted(of, np.arange(len(part)))
            mean = np.add.reduceat(embed[ids] * share[:, None], starts)
            logits = mean @ soft + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            y = np.array([p[1] for p in part])
            odds[np.arange(len(part)), y] -= 1
            grad = odds * np.array([p[2] for p in part], np.float32)[:, None] / len(part)
            to_mean = grad @ soft.T
            g_soft = mean.T @ grad
            soft_gained += g_soft**2
            soft -= step * g_soft / np.sqrt(soft_gained)
            bias -= step * grad.sum(0)
            rows, inverse = np.unique(ids, return_inverse=True)
            g = np.zeros((len(rows), DIM), np.float32)
            np.add.at(g, inverse, to_mean[of] * share[:, None])
            gained[rows] += (g**2).mean(1, keepdims=True)
            embed[rows] -= step * g / np.sqrt(gained[rows])
    return Model((embed @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _rows_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed rows of all words, one word after another, and where each word's begin; worked on in blocks."""
    flat, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for at in range(0, len(words), BLOCK):
        rows, owner = (np.concatenate(part) for part in zip(*grams(words[at : at + BLOCK])))
        flat.append(rows[np.argsort(owner, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(owner))
    return np.concatenate(flat), np.cumsum(np.concatenate(sizes))


def _word_scores(flat: np.ndarray, bounds: np.ndarray, weight: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weight[flat], dtype=np.float64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)


def _log_odds(docs: list[np.ndarray], labels: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row, the log odds of its documents' labels, less what chance may give, so that rare rows say little."""
    seen = np.zeros((2, ROWS))
    for words, label in zip(docs, labels):
        own = np.unique(words)
        n = bounds[own + 1] - bounds[own]
        at = np.repeat(bounds[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        seen[label, np.unique(flat[at])] += 1
    clean, toxic = seen + 0.5
    odds = np.log(toxic / (labels.sum() + 1)) - np.log(clean / ((1 - labels).sum() + 1))
    sure = np.abs(odds) - 2 * np.sqrt(1 / toxic + 1 / clean)
    return np.sign(odds) * np.maximum(sure, 0)


def attention(scores: np.ndarray) -> np.ndarray:
    """What share each word has in the average."""
    weights = np.exp(ATTENTION * (scores - scores.max()))
    return weights / weights.sum()


class Scorer:
    """Scores texts with a model; remembers the scores of words, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, text: str | None) -> float:
        words = words_of(text)
        known = self.known
        new = list({w for w in words if w not in known})
        if new:
            if len(known) > CACHE:
                known.clear()
                new = list(set(words))
            sums, counts = np.zeros(len(new)), np.zeros(len(new))
            for rows, owner in grams(new):
                sums += np.bincount(owner, self.model.weight[rows], len(new))
                counts += np.bincount(owner, minlength=len(new))
            known.update(zip(new, (sums / counts).tolist()))
        scores = np.fromiter((known[w] for w in words), np.float64, len(words))
        logit = self.model.bias + (float(scores @ attention(scores)) if len(scores) else NO_WORDS)
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the texts of ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``toxic``).

    Labels other than 0 and 1 are left out. At most ``sample`` rows of each class
    are used: ids are chosen first, by hash, and only their texts reach the driver. Repeated
    ids enter as often as they repeat, within the same bound.
    """
    known = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts, toxic = [], []
    for label in (0, 1):
        picked = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").limit(sample)
        for row in rows.select("text").toLocalIterator():
            texts.append(row["text"])
            toxic.append(label)
    return train(texts, np.array(toxic, np.int64))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more toxic) from ``text``; NULL counts as empty.

    A column named ``score`` is replaced; all others stay. Equal texts have equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            values = pa.array((scorer(t.as_py()) for t in batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "score"])

    return kept.mapInArrow(run, widened(kept, score="double"))
