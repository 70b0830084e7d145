"""A probabilistic suffix tree over the bytes of words, and scores of texts by it.

A text is its words, A-Z in lower case, with one space between them and one end
symbol. A context of up to DEPTH bytes is a state of the tree if it is
frequent enough to be judged, and if what follows it diverges from what follows
the context without its first byte by more than its own parameters cost; states'
suffixes are states too. A state's distribution is smoothed by its parent's,
down to a uniform one, and each byte is scored in the longest
state that its past ends in. Counts cover all training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import saved
from cellweave.llm.tokens import LOWER, SPACE, chunks, mix
from cellweave.plans.skew import broadcast_if_small

DEPTH = 7
# A context with a smaller share of all symbols is no state; so the tree has at most DEPTH / SHARE states.
SHARE = 4e-6
# A word with this share of all words is looked up in a table that each task holds: at most 1 / FREQUENT words.
FREQUENT = 1e-6
END = 255  # no UTF-8 text holds this byte
END_TOKEN = int(mix(np.array([0xE17D], np.uint64)).view(np.int64)[0])
# The kind of a count: a word's, or that of a symbol with as many bytes before it.
WORD, SHORTEST = 0, 3
# Contexts longer than SHORTEST are first counted together, by the slot of their hash.
SLOT_BITS, CHUNK_SLOTS = 20, 1024
# Counts of all kinds together that a task gathers before it hands them on.
FLUSH = 3_000_000


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of texts, one after another, each text closed by END, and where each text begins."""
    joined = b"".join((t or "").encode("utf-8", "surrogatepass") + b"\xff" for t in texts)
    data = LOWER[np.frombuffer(joined, np.uint8)]
    blank = SPACE[data]
    edges = np.flatnonzero(np.diff(blank, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    keep = ~blank
    between = (data[starts - 1] != END) & (starts > 0) & (data[ends] != END)
    keep[starts[between]] = True
    data = np.where(blank, np.uint8(32), data)[keep]
    closed = np.flatnonzero(data == END)
    return data, np.concatenate([[0], closed[:-1] + 1]) if len(closed) else np.zeros(0, np.int64)


def pasts(data: np.ndarray) -> list[np.ndarray]:
    """For every symbol those before it, the nearest first; END for all that lies before its text."""
    padded = np.concatenate([np.full(DEPTH, END, np.uint8), data])
    out, closed = [], np.zeros(len(data), bool)
    for k in range(1, DEPTH + 1):
        past = padded[DEPTH - k : len(padded) - k].copy()
        past[closed] = END
        closed = closed | (past == END)
        out.append(past)
    return out


def _parts(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a column in parts of about ``size`` bytes, with the number of the first; only one part is held as strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, begin = 0, 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, begin + size, "right")))
        yield first, texts.slice(first, last - first).to_pylist()
        first, begin = last, ends[last - 1]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(flat, kind="stable")
    flat, n = flat[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    return flat[new], np.add.reduceat(n, new)


def _keys(data: np.ndarray) -> np.ndarray:
    """Every symbol in the lowest byte of a number, under its past: the nearest byte is the highest."""
    key = data.astype(np.uint64)
    for k, past in enumerate(reversed(pasts(data))):
        key |= past.astype(np.uint64) << np.uint64(8 * (k + 1))
    return key


def _slots(key: np.ndarray, k: int) -> np.ndarray:
    context = key >> np.uint64(8 * (DEPTH + 1 - k))
    return ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def busy_slots(docs: DataFrame) -> np.ndarray:
    """For each length from SHORTEST + 1 on, which slots hold enough for a state; a context in another one is too rare.

    Only a slot's sum over all rows is judged, so no context with a share of SHARE is lost.
    """
    lengths = range(SHORTEST + 1, DEPTH + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(lengths), 1 << SLOT_BITS), np.int64)
        for batch in batches:
            for _, texts in _parts(batch.column(0)):
                key = _keys(symbols(texts)[0])
                for k in lengths:
                    sums[k - SHORTEST - 1] += np.bincount(_slots(key, k), minlength=1 << SLOT_BITS)
        if sums.any():
            parts = sums.reshape(-1, CHUNK_SLOTS)
            values = pa.array([p.astype(np.int32 if p.max() < 1 << 31 else np.int64).tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), values], names=["part", "sums"])

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK_SLOTS, np.int64)
        for value in part.column("sums"):
            raw = value.as_py()
            total += np.frombuffer(raw, np.int32 if len(raw) == 4 * CHUNK_SLOTS else np.int64)
        return pa.table({"part": part.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, sums binary"
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, schema)
    sums = np.zeros((len(lengths), 1 << SLOT_BITS), np.int64)
    # As many rows as there are parts, whatever the size of the corpus.
    for row in found.groupBy("part").applyInArrow(add, schema).toLocalIterator():
        sums.reshape(-1, CHUNK_SLOTS)[row["part"]] = np.frombuffer(row["sums"], np.int64)
    return sums >= SHARE * sums[0].sum()


def counts(docs: DataFrame) -> DataFrame:
    """``kind``, ``key`` and ``n`` over all rows of ``docs`` (``text``): words by hash, and symbols with their past.

    A symbol is counted once, with the longest past that may be a state; what lies before that past is 0 in ``key``.
    """
    busy = docs.sparkSession.sparkContext.broadcast(np.packbits(busy_slots(docs), axis=1))
    lengths = range(SHORTEST, DEPTH + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {kind: ([], []) for kind in (WORD, *lengths)}
        may_be = np.unpackbits(busy.value, axis=1).astype(bool)

        for batch in batches:
            for _, texts in _parts(batch.column(0)):
                for _, hashes, bounds in chunks(texts):
                    ends = np.full(len(bounds) - 1, END_TOKEN, np.int64).view(np.uint64)
                    _add(held[WORD], np.concatenate([hashes, ends]))
                key = _keys(symbols(texts)[0])
                for k in reversed(lengths):
                    longest = may_be[k - SHORTEST - 1][_slots(key, k)] if k > SHORTEST else np.ones(len(key), bool)
                    dropped = ((1 << 8 * (DEPTH - k)) - 1) << 8
                    _add(held[k], key[longest] & np.uint64(~dropped & (2**64 - 1)))
                    key = key[~longest]
                yield from _handed_on(held, FLUSH)
        yield from _handed_on(held, 0)

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "kind byte, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _add(held: tuple[list, list], keys: np.ndarray) -> None:
    keys = np.sort(keys)
    if len(keys):
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        held[0].append(keys[new])
        held[1].append(np.diff(np.append(new, len(keys))))


def _handed_on(held: dict[int, tuple[list, list]], limit: int) -> Iterator[pa.RecordBatch]:
    """Once more than ``limit`` counts are held, of all kinds together, they are merged, and the largest kinds go until half are left."""
    if sum(len(a) for keys, _ in held.values() for a in keys) <= limit:
        return
    sizes = {}
    for kind, (keys, n) in held.items():
        if keys:
            keys[:], n[:] = ([a] for a in _merged(keys, n))
            sizes[kind] = len(keys[0])
    left = sum(sizes.values())
    for kind in sorted(sizes, key=sizes.get, reverse=True):
        if left <= limit / 2:
            return
        keys, n = held[kind]
        kinds = pa.array(np.full(sizes[kind], kind, np.int8))
        yield pa.RecordBatch.from_arrays([kinds, pa.array(keys[0].view(np.int64)), pa.array(n[0])], names=["kind", "key", "n"])
        keys.clear()
        n.clear()
        left -= sizes[kind]


@dataclass(frozen=True)
class Tree:
    """States as numbers, 0 the root. ``child[state, symbol]``: the state whose context has one more symbol before, or -1.

    ``symbol`` maps bytes to columns; all bytes that training never saw share column 0.
    """

    symbol: np.ndarray
    child: np.ndarray
    log10: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The log10 probability of each text."""
        data, starts = symbols(texts)
        child, log10, width = self.child.ravel(), self.log10.ravel(), self.child.shape[1]
        state = np.zeros(len(data), np.int64)
        live, at = np.arange(len(data)), state
        for past in pasts(data):
            after = child.take(at * width + self.symbol.take(past.take(live)))
            deeper = np.flatnonzero(after >= 0)
            live, at = live.take(deeper), after.take(deeper).astype(np.int64)
            state[live] = at
        return np.add.reduceat(log10.take(state * width + self.symbol.take(data)).astype(np.float64), starts)


def grow(grams: DataFrame) -> Tree:
    """The tree from counts (``kind``, ``key``, ``n``) of symbols with ``kind`` bytes of their past."""
    # Contexts of every length k: the k bytes nearest to the symbol.
    every = grams.select(F.explode(F.sequence(F.lit(0), F.col("kind").cast("int"))).alias("k"), "key", "n")
    context = F.expr(f"if(k = 0, 0L, shiftrightunsigned(key, 8 * ({DEPTH + 1} - k)))")
    rows = every.select("k", context.alias("context"), F.col("key").bitwiseAND(F.lit(255)).alias("symbol"), "n")
    rows = saved(rows.groupBy("k", "context", "symbol").agg(F.sum("n").alias("n")), "lm-rows")
    totals = rows.groupBy("k", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    whole = rows.filter("k = 0").agg(F.sum("n").alias("n")).first()["n"] or 0
    totals = saved(totals.filter(F.col("total") >= SHARE * whole), "lm-totals")
    child = rows.join(broadcast_if_small(totals), ["k", "context"]).withColumn("above", F.shiftright("context", 8))
    parent = rows.join(broadcast_if_small(totals), ["k", "context"]).select(
        (F.col("k") + 1).alias("k"), F.col("context").alias("above"), "symbol", (F.col("n") / F.col("total")).alias("expected")
    )
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("expected")))
    judged = child.join(parent, ["k", "above", "symbol"]).groupBy("k", "context", "total", "kinds").agg(gain.alias("gain"))
    # What a state says of its future must outweigh the description of its own parameters.
    states = judged.filter(F.col("gain") > 0.5 * F.col("kinds") * F.log(F.col("total"))).select("k", "context")
    suffix = F.explode(F.sequence(F.lit(0), F.col("k"))).alias("_k")
    states = states.select("k", "context", suffix).select(
        F.col("_k").alias("k"), F.expr("shiftright(context, 8 * (k - _k))").alias("context")
    )
    states = saved(states.distinct(), "lm-states")
    # Bounded by SHARE: at most DEPTH / SHARE states of at most 256 symbols.
    kept = rows.filter("k > 0").join(broadcast_if_small(states), ["k", "context"], "left_semi")
    # As columns: a row object for each would be the most that the driver holds.
    return _tree(rows.filter("k = 0").unionByName(kept).toArrow().to_pandas())


def _tree(rows) -> Tree:
    rows = rows.sort_values(["k", "context", "symbol"], ignore_index=True)
    seen = np.sort(rows["symbol"][rows["k"] == 0].to_numpy(np.int64))
    symbol = np.zeros(256, np.uint8)
    symbol[seen] = np.arange(1, len(seen) + 1) if len(seen) < 256 else np.arange(256)
    width = max(len(seen) + 1, 1) if len(seen) < 256 else 256
    # Dense arrays are single precision and the counts stay sparse, as the driver holds them.
    heads = np.flatnonzero(~rows.duplicated(["k", "context"]).to_numpy())
    tails = np.append(heads[1:], len(rows))
    column, n = symbol[rows["symbol"].to_numpy(np.int64)], rows["n"].to_numpy(np.float64)
    lengths, contexts = rows["k"].to_numpy(np.int64)[heads].tolist(), rows["context"].to_numpy(np.int64)[heads].tolist()
    del rows
    number: dict[tuple[int, int], int] = {}
    chance = np.full((max(len(heads), 1), width), 1.0 / 256, np.float32)
    child = np.full(chance.shape, -1, np.int32)
    for state, (k, context, lo, hi) in enumerate(zip(lengths, contexts, heads.tolist(), tails.tolist())):
        number[k, context] = state
        before, weight = np.full(width, 1.0 / 256), 1.0
        if k:
            above = number[k - 1, context >> 8]
            child[above, symbol[context & 255]] = state
            before, weight = chance[above].astype(np.float64), float(hi - lo)
        mass = weight * before
        np.add.at(mass, column[lo:hi], n[lo:hi])
        chance[state] = mass / (n[lo:hi].sum() + weight)
    np.log10(chance, out=chance)
    return Tree(symbol, child, chance)


def score(docs: DataFrame, training: Column) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id``, ``text``) by what the rows where ``training`` holds teach.

    Columns: ``doc_id``, ``n_tokens`` and ``n_known`` (words and the end; known: seen
    in training), ``train_tokens``, ``base_score`` (words alone, with one added
    to each count) and ``score`` (the tree's log10 probability). NULL and empty texts are
    an end only. Without training rows all symbols are equally likely. Words are told apart by 64-bit hashes.
    """
    learnt = saved(counts(docs.filter(training)), "lm-counts")
    tree = grow(learnt.filter(F.col("kind") != WORD))
    words = learnt.filter(F.col("kind") == WORD).select(F.col("key").alias("word"), "n")
    facts = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds")).first()
    tokens, kinds = facts["tokens"], facts["kinds"]
    frequent = words.filter(F.col("n") >= max(1.0, FREQUENT * tokens)).toArrow().to_pandas().sort_values("word")
    table = (frequent["word"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast((tree, table))
    divisor = np.log10(float(tokens + kinds + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (known, n) = shared.value
        for batch in batches:
            for first, texts in _parts(batch.column(1)):
                ids = batch.column(0).slice(first, len(texts))
                scores = tree.score(texts)
                for at, hashes, bounds in chunks(texts):
                    size = len(bounds) - 1
                    yield _base(ids.slice(at, size), scores[at : at + size], hashes, bounds, known, n, divisor)

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<long>, rare_n array<int>"
    per_row = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    per_row = saved(per_row.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "lm-rows")
    pairs = per_row.select("_row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
    rare = words.filter(F.col("n") < max(1.0, FREQUENT * tokens))
    met = pairs.select("_row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times")).join(rare, "word")
    # A rare word that training lacks is already scored with a count of 0; here comes the difference.
    more = met.groupBy("_row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("_score"), F.sum("times").alias("_known")
    )
    return per_row.join(more, "_row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_score", F.lit(0.0))).alias("base_score"),
        "score",
    )


def _base(ids, scores, hashes, bounds, known, n, divisor) -> pa.RecordBatch:
    """What the table of frequent words gives for texts, and the words that it lacks, with their numbers."""
    size = len(bounds) - 1
    ends = np.full(size, END_TOKEN, np.int64)
    word = np.concatenate([hashes.view(np.int64), ends])
    text = np.concatenate([np.repeat(np.arange(size), np.diff(bounds)), np.arange(size)])
    found = np.zeros(len(word), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, word), len(known) - 1)
        found = np.where(known[at] == word, n[at], 0)
    base = np.bincount(text, np.log10(found + 1.0) - divisor, size)
    hits = np.bincount(text, found > 0, size).astype(np.int64)
    missing = found == 0
    order = np.lexsort((word[missing], text[missing]))
    w, t = word[missing][order], text[missing][order]
    new = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (t[1:] != t[:-1])])) if len(w) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(w))).astype(np.int32)
    offsets = pa.array(np.searchsorted(t[new], np.arange(size + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(np.diff(bounds).astype(np.int64) + 1),
            pa.array(hits),
            pa.array(base),
            pa.array(scores),
            pa.ListArray.from_arrays(offsets, pa.array(w[new])),
            pa.ListArray.from_arrays(offsets, pa.array(times)),
        ],
        names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rare", "rare_n"],
    )
