"""Remove byte strings that an earlier document already holds, by sorting suffixes.

A suffix is known by its first LENGTH bytes: two tokens of half that length, each
coded in 64 bits. Suffixes are partitioned by ranges of (tokens, document)
whose splitters are sampled, each bucket is sorted by multikey quicksort, and
suffixes with equal tokens, which now lie side by side, are compared by document. As
the document is part of the order, a string that a third of all documents hold fills several
buckets; what the ends of buckets say of such a string is put together afterwards.

Only suffixes that may repeat are sorted. Among the half-length strings inside a
suffix's first LENGTH bytes the one with the least code is its anchor; equal
suffixes have equal anchors, so those whose anchor occurs in one text only are left out,
and so are whole copies of a text, which are known by their digest. Texts of one least
anchor, mostly near copies, are worked on together: of equal suffixes there only those of the first
text go on to the buckets, and none where all texts with an anchor are there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import drop_saved, saved
from cellweave.llm.tokens import mix, powers
from cellweave.plans.skew import MAX_BROADCAST_BYTES, broadcast_if_small

LENGTH = 50
HALF = LENGTH // 2
# Suffixes of one bucket, about; a bucket is sorted in one task's memory.
BUCKET_ROWS = 500_000
# Sampled suffixes for each bucket, and texts from which on not all are looked at to sample.
SAMPLE_EACH, SAMPLE_TEXTS = 50, 2_000
# A group of near copies with suffixes for more buckets than this is dealt to several tasks.
TASK_BLOCKS = 8
# Bytes of text that are worked on together.
PIECE = 1 << 18
# Segments as short as this are left to numpy's sort.
SHORT = 1 << 15
# Suffixes for one anchor, about.
PER_ANCHOR = HALF // 2
NO_ID = (1 << 63) - 1
_VALUE = np.random.default_rng(50_025).integers(1, 2**63, 256).astype(np.uint64)
DECIDED, OPEN, EDGE = 0, 1, 2


def _pieces(texts: list[str | None], size_each: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of about ``size_each`` together, and of each part: its text's number, its place there, and its end in the bytes.

    A longer text comes in parts that share LENGTH - 1 bytes, so each of its suffixes starts in one part.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        for at in range(0, len(raw) - LENGTH + 1, size_each):
            part = raw[at : at + size_each + LENGTH - 1]
            if held and size + len(part) > 2 * size_each:
                yield _joined(held)
                held, size = [], 0
            held.append((part, i, at))
            size += len(part)
    if held:
        yield _joined(held)


def _joined(held: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p for p, _, _ in held), np.uint8)
    return data, np.array([i for _, i, _ in held]), np.array([a for _, _, a in held]), np.cumsum([len(p) for p, _, _ in held])


def suffixes(texts: list[str | None], size_each: int = PIECE) -> Iterator[tuple[np.ndarray, ...]]:
    """Of every suffix of LENGTH bytes and more: text, place, both tokens, and its anchor's code and place in the bytes."""
    for data, text, offset, ends in _pieces(texts, size_each):
        up, down = powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up[: len(data)], dtype=np.uint64)])
        code = mix((sums[HALF:] - sums[:-HALF]) * down[: len(data) - HALF + 1])
        least = (code & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(code), dtype=np.uint64)
        span = 1
        while 2 * span <= HALF + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = HALF + 1 - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
        begins = np.concatenate([[0], ends[:-1]])
        sizes = ends - begins - LENGTH + 1
        part = np.repeat(np.arange(len(ends)), sizes)
        start = np.arange(sizes.sum()) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
        anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        yield text[part], offset[part] + start - begins[part], code[start], code[start + HALF], code[anchor], anchor


def multikey_quicksort(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by ``columns``, the first one first.

    A segment is split in three by one column's pivot; the middle part, equal there, goes on with the next column.
    """
    done: list[np.ndarray] = []
    stack = [(np.arange(len(columns[0])), 0)]
    while stack:
        rows, at = stack.pop()
        if at == len(columns) or len(rows) <= 1:
            done.append(rows)
        elif len(rows) <= SHORT:
            done.append(rows[np.lexsort([c[rows] for c in reversed(columns[at:])])])
        else:
            values = columns[at][rows]
            pivot = np.sort(values[:: len(values) // 15])[8]
            stack.append((rows[values > pivot], at))
            stack.append((rows[values == pivot], at + 1))
            stack.append((rows[values < pivot], at))
    return np.concatenate(done)


def _anchors(texts: DataFrame) -> DataFrame:
    """``node`` and ``anchor`` of ``texts`` (``node``, ``text``), each once for a part of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for text, _, _, _, code, place in suffixes(batch.column(1).to_pylist()):
                new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
                text, code = text[new], code[new]
                order = np.lexsort((code, text))
                text, code = text[order], code[order]
                new = np.concatenate([[True], (code[1:] != code[:-1]) | (text[1:] != text[:-1])])
                columns = [pa.array(nodes[text[new]]), pa.array(code[new].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "anchor"])

    return texts.select("node", "text").mapInArrow(run, "node long, anchor long")


Suffixes = tuple[np.ndarray, ...]  # first, second, rank, node, place


def _candidates(batch: pa.RecordBatch) -> Iterator[tuple[Suffixes, np.ndarray, np.ndarray]]:
    """The suffixes of texts (``node``, ``rank``, ``text``, ``anchors``) that have one of the anchors, and which.

    With them come the anchors (``anchor``, ``n``) of those texts that are whole here, not in parts.
    """
    nodes, ranks, anchors, raws = (batch[c] for c in ("node", "rank", "anchors", "text"))
    nodes, ranks, raws = nodes.to_numpy(), ranks.to_numpy(), raws.to_pylist()
    for text, place, first, second, code, _ in suffixes(raws):
        own = np.unique(text)
        kept = np.zeros(len(text), bool)
        whole = [np.zeros((2, 0), np.int64)]
        for lo, hi, i in zip(np.searchsorted(text, own), np.searchsorted(text, own, "right"), own):
            of_text = np.stack([anchors[int(i)].values.field(k).to_numpy() for k in (0, 1)])
            kept[lo:hi] = np.isin(code[lo:hi], of_text[0].view(np.uint64))
            if hi - lo <= PIECE and len(raws[i].encode("utf-8", "surrogatepass")) == hi - lo + LENGTH - 1:
                whole.append(of_text)
        t = text[kept]
        suffix = first[kept].view(np.int64), second[kept].view(np.int64), ranks[t], nodes[t], place[kept].astype(np.int32)
        yield suffix, code[kept].view(np.int64), np.concatenate(whole, axis=1)


def _settled(anchor: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which suffixes meet no other outside of this block: all texts with their ``anchor`` are whole in it.

    Equal suffixes have equal anchors. ``whole`` lists each text's anchors, and in how many texts they are.
    """
    found, at, times = np.unique(whole[0], return_index=True, return_counts=True)
    return np.isin(anchor, found[whole[1][at] == times])


def _ordered(parts: list[Suffixes]) -> tuple[Suffixes, np.ndarray]:
    """All suffixes in order, and where each string begins among them."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    order = multikey_quicksort(columns[:3])
    columns = tuple(c[order] for c in columns)
    first, second = columns[:2]
    new = np.concatenate([np.ones(min(len(first), 1), bool), (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
    return columns, np.flatnonzero(new)


def _later(rank: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Whether a suffix's string has a suffix of smaller rank before it."""
    return rank > np.repeat(rank[heads], np.diff(np.append(heads, len(rank))))


def _runs(node: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node, first and last place of every run of consecutive places."""
    order = np.lexsort((place, node))
    node, place = node[order], place[order]
    new = np.concatenate([np.ones(min(len(node), 1), bool), (node[1:] != node[:-1]) | (place[1:] != place[:-1] + 1)])
    heads = np.flatnonzero(new)
    return node[heads], place[heads], place[np.append(heads[1:], len(node)) - 1] if len(heads) else place[heads]


def _splitters(texts: DataFrame, n_texts: int, n_suffixes: int, buckets: int) -> list[tuple[int, int, int]]:
    """Ends (first, second, rank) of all buckets but the last, from suffixes of texts chosen by hash.

    They decide how even buckets are, and nothing else. Some SAMPLE_EACH suffixes a bucket come to the driver.
    """
    if buckets == 1:
        return []
    one_in = int(np.clip(n_texts // SAMPLE_TEXTS, 1, 64))
    step = max(1, n_suffixes // (buckets * SAMPLE_EACH * one_in))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (first, second, rank, _, _), _, _ in _candidates(batch):
                rows = mix(first.view(np.uint64) ^ rank.view(np.uint64)) % np.uint64(step) == 0
                columns = [pa.array(c[rows]) for c in (first, second, rank)]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "second", "rank"])

    chosen = texts.filter(F.pmod(F.xxhash64("node"), F.lit(one_in)) == 0)
    found = chosen.mapInArrow(run, "first long, second long, rank long").toArrow()
    first, second, rank = (found[c].to_numpy() for c in ("first", "second", "rank"))
    order = multikey_quicksort([first, second, rank])
    ends = order[np.arange(1, buckets) * len(order) // buckets] if len(order) else order
    return sorted(set(zip(first[ends].tolist(), second[ends].tolist(), rank[ends].tolist())))


def _bucketed(texts: DataFrame, splitters: list[tuple[int, int, int]]) -> DataFrame:
    """Suffixes of ``texts`` by ``bucket``: blocks of those that no other of the same block precedes, and runs of all others.

    A text's neighbours in a block are likely near copies of it, so most of what repeats is
    decided before it is shuffled, and what occurs in no other block is left out. A block is one row a bucket (``packed``); a run is ``node``, ``place`` and ``upto``.
    """
    shared = texts.sparkSession.sparkContext.broadcast(splitters)
    buckets = len(splitters) + 1
    names = ["bucket", "packed", "node", "place", "upto"]

    def block(parts: list[tuple[Suffixes, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        (*suffix, anchor), heads = _ordered([(*found, code) for found, code, _ in parts])
        later = _later(suffix[2], heads)
        nodes, places, upto = _runs(suffix[3][later], suffix[4][later])
        if len(nodes):
            none = pa.nulls(len(nodes), pa.binary())
            of = (nodes % buckets).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (of, none, nodes, places, upto)], names=names)
        more = ~later & ~_settled(anchor, np.concatenate([w for _, _, w in parts], axis=1))
        suffix = tuple(c[more] for c in suffix)
        if not len(suffix[0]):
            return
        of = _bucket_of(suffix, shared.value)
        edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
        packed = [b"".join(c[a:b].tobytes() for c in suffix) for a, b in zip(edges[:-1], edges[1:])]
        none = [pa.nulls(len(packed), t) for t in (pa.int64(), pa.int32(), pa.int32())]
        columns = [pa.array(of[edges[:-1]].astype(np.int32)), pa.array(packed, pa.binary()), *none]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in (p for batch in batches for p in _candidates(batch)):
            held.append(part)
            size += len(part[1])
            if size >= BUCKET_ROWS:
                yield from block(held)
                held, size = [], 0
        if size:
            yield from block(held)

    return texts.mapInArrow(run, "bucket int, packed binary, node long, place int, upto int")


def _bucket_of(suffix: Suffixes, splitters: list[tuple[int, int, int]]) -> np.ndarray:
    """How many splitters are less than each suffix."""
    first = np.array([s[0] for s in splitters], np.int64)
    bucket, most = np.searchsorted(first, suffix[0]), np.searchsorted(first, suffix[0], "right")
    for i in np.flatnonzero(bucket < most):
        bucket[i] = bisect_left(splitters, tuple(int(c[i]) for c in suffix[:3]))
    return bucket


def _unpacked(raw: bytes) -> Suffixes:
    n = len(raw) // 36
    longs = np.frombuffer(raw, np.int64, 4 * n).reshape(4, n)
    return (*longs, np.frombuffer(raw, np.int32, n, 32 * n))


def _compared(blocks: DataFrame) -> DataFrame:
    """One bucket a partition: runs of suffixes with an earlier equal (DECIDED), those equal to its first one (OPEN), and its EDGEs."""
    names = ["kind", "first", "second", "rank", "node", "place", "upto"]

    def told(kind: int, suffix: Suffixes, rows: np.ndarray) -> pa.RecordBatch:
        columns = [np.full(len(rows), kind, np.int8), *(c[rows] for c in suffix), suffix[4][rows]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def decided(node: pa.Array, place: pa.Array, upto: pa.Array) -> pa.RecordBatch:
        kind, none = pa.array(np.full(len(node), DECIDED, np.int8)), pa.nulls(len(node), pa.int64())
        return pa.RecordBatch.from_arrays([kind, none, none, none, node, place, upto], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            known = batch.filter(pc.is_valid(batch["node"]))
            yield decided(known["node"], known["place"], known["upto"])
            parts += [_unpacked(raw.as_py()) for raw in batch["packed"].drop_null()]
        if not parts:
            return
        suffix, heads = _ordered(parts)
        parts.clear()
        later = _later(suffix[2], heads)
        later[: heads[1] if len(heads) > 1 else len(later)] = False
        yield told(OPEN, suffix, np.arange(heads[1] if len(heads) > 1 else len(later)))
        yield told(EDGE, suffix, heads[[0, -1]])
        yield decided(*map(pa.array, _runs(suffix[3][later], suffix[4][later])))

    schema = "kind byte, first long, second long, rank long, node long, place int, upto int"
    return blocks.mapInArrow(run, schema)


def repeats(texts: DataFrame) -> DataFrame:
    """``node`` and ``runs`` of places of the suffixes whose first LENGTH bytes also start in a text of smaller ``rank``.

    ``texts`` is a table of ``node`` (distinct), ``rank`` and ``text``.
    """
    anchors = saved(_anchors(texts), "suffix-anchors")
    many = anchors.groupBy("anchor").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("n"))
    many = broadcast_if_small(saved(many.filter("a < b").select("anchor", "n"), "suffix-shared"))
    every = F.collect_set(F.struct("anchor", "n")).alias("anchors")
    listed = anchors.join(many, "anchor").groupBy("node").agg(every, F.min("anchor").alias("lead"))
    listed = saved(listed, "suffix-listed")
    drop_saved(anchors)
    # Near copies mostly have the same least anchor; a large group of them is dealt to several tasks.
    size = F.sum(F.size("anchors").cast("long"))
    slots = F.ceil(size * PER_ANCHOR / (TASK_BLOCKS * BUCKET_ROWS)).alias("slots")
    large = listed.groupBy("lead").agg(slots).filter("slots > 1")
    slot = F.pmod(F.xxhash64("node"), F.coalesce("slots", F.lit(1)))
    together = listed.join(broadcast_if_small(large), "lead", "left").select("node", "anchors", "lead", slot.alias("slot"))
    held = listed.agg(F.count("*").alias("texts"), size.alias("anchors")).first()
    n_suffixes = (held["anchors"] or 0) * PER_ANCHOR
    small = (held["anchors"] or 0) * 16 + held["texts"] * 48 <= MAX_BROADCAST_BYTES
    wanted = texts.join(F.broadcast(together) if small else together, "node")
    wanted = saved(wanted.select("node", "rank", "text", "anchors", "lead", "slot"), "suffix-wanted")
    drop_saved(listed)
    # Files, and so Arrow batches, hold texts in the order of their groups.
    near = wanted.repartition("lead", "slot").sortWithinPartitions("lead").drop("lead", "slot")
    near = saved(near, "suffix-near")
    drop_saved(wanted)
    splitters = _splitters(near, held["texts"], n_suffixes, max(1, n_suffixes // BUCKET_ROWS))
    blocks = _bucketed(near, splitters).repartitionById(len(splitters) + 1, F.col("bucket"))
    told = saved(_compared(blocks), "suffix-told")
    drop_saved(near)
    edges = told.filter(F.col("kind") == EDGE).groupBy("first", "second").agg(F.min("rank").alias("least"))
    late = told.filter(F.col("kind") == OPEN).join(broadcast_if_small(edges), ["first", "second"]).filter("rank > least")
    run = F.struct("place", "upto").alias("run")
    found = told.filter(F.col("kind") == DECIDED).select("node", run).unionByName(late.select("node", run))
    return found.groupBy("node").agg(F.collect_list("run").alias("runs"))


def removed(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with ``n_bytes``, the removed ``spans`` and the bytes ``kept``.

    A byte goes if a string of LENGTH bytes that covers it also starts in a row with a smaller
    id; the input is judged, not what is left of it. ``spans`` are maximal
    removed runs (``start``, ``end``) in UTF-8 bytes, in order. NULL counts as empty. Rows with one
    id don't remove from each other; rows without an id come after all others. Other columns are left out.
    Work on a text is bounded by its own length.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rank = F.coalesce("doc_id", F.lit(NO_ID)).alias("rank")
    digest = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest")
    rows = saved(rows.select("doc_id", "text", rank, digest, F.monotonically_increasing_id().alias("node")), "suffix-rows")
    least = rows.groupBy("digest").agg(F.min("rank").alias("least"))
    copies = rows.select("node", "rank", "digest").join(least, "digest").filter("rank > least").select("node", F.lit(True).alias("copy"))
    copies = saved(copies, "suffix-copies")
    found = repeats(rows.join(copies, "node", "left_anti").select("node", "rank", "text"))
    every = found.select("node", "runs", F.lit(False).alias("copy")).unionByName(
        copies.select("node", F.lit(None).cast("array<struct<place: int, upto: int>>").alias("runs"), "copy")
    )
    return _cut(rows.select("node", "doc_id", "text").join(every, "node", "left").select("doc_id", "text", "runs", "copy"))


def _cut(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, told, copy in zip(batch.column(1), batch.column(2), batch.column(3)):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                runs = [(0, len(raw))] if copy.as_py() and len(raw) >= LENGTH else []
                if told.is_valid:
                    place, upto = (told.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                    order = np.argsort(place)
                    place, upto = place[order], upto[order]
                    # Places no further apart than LENGTH belong to one run.
                    heads = np.flatnonzero(np.concatenate([[True], place[1:] - upto[:-1] > LENGTH]))
                    tails = np.append(heads[1:], len(place)) - 1
                    runs = [(int(place[a]), int(upto[b]) + LENGTH) for a, b in zip(heads, tails)]
                edges = [0, *(e for r in runs for e in r), len(raw)]
                sizes.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
