"""Near duplicates of multisets of word shingles, by BagMinHash signatures.

Each shingle runs Poisson processes over time and over its discretised weight:
one on the unit [0, 1), and one on each further interval [2^j, 2^(j+1)), at a rate of
the interval's length. A point counts where it lies below the shingle's weight
and goes to one of the signature's slots; a slot keeps its earliest point. Texts agree in a slot
with a probability equal to their weighted Jaccard similarity. Points past a
time by which all slots are surely filled are never drawn.

Signatures are cut into bands. Texts that share a band are compared, all
with a leader among them, exactly: by multiset overlap. Those that differ from it
meet again among themselves; then all that share a band and are not
connected yet meet, but for those that exact bounds part. In large bands those are found by shingles that
part them alike from their leader. Connected texts form a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from cellweave.llm.linking import class_ids, linked
from cellweave.llm.shared import saved, unused, widened
from cellweave.llm.tokens import chunks, mix
from cellweave.plans.skew import broadcast_if_small

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8 a pair shares no band with a probability of 3e-6.
BANDS, ROWS = 24, 4
SLOTS = BANDS * ROWS
# What the leader of a band does not settle meets again where FINE_ROWS slots agree, in any of FINE choices
# of slots: a pair at 0.8 shares none with a probability below 1e-5, one at 0.4 shares one with 4e-2.
FINE, FINE_ROWS = 64, 8
# Slots that agree from which on such a pair is compared; all others are left to the last comparison, which is exact.
LIKELY = 72
# Slots that count how often elements part texts from leaders.
OFTEN_BITS = 20
# Parting elements that are counted together, and those that are packed or looked at together.
ELEMENTS, TOGETHER = 1 << 20, 1 << 18
# How far past the mean time to fill all slots the first drawing goes.
MARGIN = 3.0
Bag = tuple[np.ndarray, np.ndarray]  # shingles in order, and how often
_KEEP = np.uint64((1 << 48) - 1)
# Stands for all slots where they are counted.
ALL = -1
# An element of a front: 16 bytes each of its node's and its leader's name, and what ``_fronts`` tells of it.
_FRONT = np.dtype([("names", np.uint64, 4), ("element", np.int64), ("place", np.int64), ("gap", np.int64), ("indexed", bool)])
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


# Texts whose shingles are sorted together at most.
_OWNERS = 1 << 16


def shingle_bags(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, 48-bit shingle and count, sorted, for texts of tokens ``hashes[bounds[i]:bounds[i + 1]]``.

    A text of fewer than SHINGLE words, but not none, is one shingle.
    """
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    shingles, owners = [], []
    if len(hashes) >= SHINGLE:
        last = len(hashes) - SHINGLE + 1
        total = sum(hashes[i : i + last] * np.uint64(f) for i, f in enumerate(_FACTORS))
        whole = text[:last] == text[SHINGLE - 1 :]
        shingles.append(mix(total[whole]))
        owners.append(text[:last][whole])
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        own = hashes[bounds[i] : bounds[i + 1]]
        total = sum(int(h) * f for h, f in zip(own, _FACTORS)) + len(own)
        shingles.append(mix(np.array([total & (2**64 - 1)], np.uint64)))
        owners.append(np.array([i], np.uint64))
    if not shingles:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    keys = np.concatenate(owners) << np.uint64(48) | np.concatenate(shingles) & _KEEP
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    weights = np.diff(np.append(new, len(keys)))
    return (keys[new] >> np.uint64(48)).astype(np.int64), keys[new] & _KEEP, weights


def bag_signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Signatures of ``n`` bags, given as sorted (text, element, integer weight); of an empty bag all zero."""
    total = np.bincount(text, weight, n)
    out = np.zeros((n, SLOTS), np.uint32)
    left = np.flatnonzero(total > 0)
    # One process per element and interval below its weight.
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    of = np.repeat(np.arange(len(weight)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    seeds = mix(element[of] + (level.astype(np.uint64) + np.uint64(1) << np.uint64(50)))
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.maximum(low, 1.0)
    limit = (np.log(SLOTS) + MARGIN) / np.maximum(total, 1)
    while len(left):
        wanted = np.zeros(n, bool)
        wanted[left] = True
        earliest = np.full(n * SLOTS, np.inf)
        live = np.flatnonzero(wanted[text[of]])
        owner, seed, top = text[of[live]], seeds[live], weight[of[live]]
        start, width = low[live], length[live]
        time = np.zeros(len(live))
        step = 0
        while len(owner):
            step += 1
            draw = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            time = time - np.log1p((draw >> np.uint64(11)) * -(2.0**-53)) / (SLOTS * width)
            keep = time <= limit[owner]
            owner, seed, top, start, width, time = (a[keep] for a in (owner, seed, top, start, width, time))
            place = mix(draw[keep] ^ np.uint64(0x5851F42D4C957F2D))
            slot = (place >> np.uint64(40)) * np.uint64(SLOTS) >> np.uint64(24)
            height = start + width * ((place & np.uint64(0xFFFFFFFF)) * 2.0**-32)
            counts = height < top
            np.minimum.at(earliest, owner[counts] * SLOTS + slot[counts].astype(np.int64), time[counts])
        table = earliest.reshape(n, SLOTS)
        full = left[np.isfinite(table[left]).all(1)]
        out[full] = (mix(table[full].view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        left = np.setdiff1d(left, full)
        limit = limit * 2
    return out


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``signature`` (array of SLOTS ints) and ``shingles``, the size of the bag.

    NULL and empty texts, and those without words, have a NULL signature and 0
    shingles. Columns of these names are replaced.
    """
    kept = docs.drop("signature", "shingles")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A shingle's key has 16 bits for the number of its text.
        for batch in (b.slice(i, _OWNERS) for b in batches for i in range(0, b.num_rows, _OWNERS)):
            for first, hashes, bounds in chunks(t.as_py() for t in batch.column(at)):
                n = len(bounds) - 1
                owner, element, weight = shingle_bags(hashes, bounds)
                signed = bag_signatures(owner, element, weight, n)
                sizes = np.bincount(owner, weight, n).astype(np.int64)
                flat = pa.array(signed.reshape(-1).view(np.int32), pa.int32())
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * SLOTS)
                lists = pa.ListArray.from_arrays(offsets, flat, mask=pa.array(sizes == 0))
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, pa.array(sizes)], names=[*part.schema.names, "signature", "shingles"]
                )

    return kept.mapInArrow(run, widened(kept, signature=ArrayType(IntegerType()), shingles="long"))


def content_of(text: Column) -> Column:
    """A 16-byte name of a text; NULL counts as empty."""
    return F.unhex(F.md5(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8")))


def representatives(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is that of their class, so one document of each class, with all columns.

    Of equal rows one stays; rows without an id all stay, and so do different texts with one id that names their class.
    """
    named = _rows(docs, similarity)
    away = named.filter(F.col("doc_id") != F.col("class_id")).select("doc_id", "node")
    node, gone, its_id = (unused(n, docs) for n in ("_node", "_away", "_id"))
    kept = docs.withColumn(node, content_of(F.col("text")))
    away = saved(away.distinct(), "bag-away").select(F.col("doc_id").alias(its_id), F.col("node").alias(gone))
    kept = kept.join(
        broadcast_if_small(away), (F.col(node) == F.col(gone)) & (F.col("doc_id") == F.col(its_id)), "left_anti"
    )
    if not named.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        unnamed = kept.filter("doc_id IS NULL")
        kept = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", node]).unionByName(unnamed)
    return kept.select(*docs.columns)


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id``, the least id among its near duplicates, for each row of ``docs`` (``doc_id``, ``text``).

    Equal texts are one class, and so are texts that links of ``similarity`` or more
    connect. A text without words is in a class with equal texts only. Rows
    without an id take their place in classes, whose id is NULL if none has one.
    """
    return _rows(docs, similarity).select("doc_id", "class_id")


def _rows(docs: DataFrame, similarity: float) -> DataFrame:
    """``doc_id``, ``node`` and ``class_id`` of each row."""
    named = docs.select("doc_id", content_of(F.col("text")).alias("node"), "text")
    signed = saved(signatures(named).drop("text"), "bag-signatures")
    nodes = saved(signed.groupBy("node").agg(F.min("doc_id").alias("least")), "bag-nodes")
    band = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda b: F.xxhash64(b, F.slice("signature", b * ROWS + 1, ROWS)),
        )
    )
    # One row per text and band; rows of equal texts meet in the aggregate before they are shuffled.
    open_rows = signed.filter(F.col("signature").isNotNull()).select("node", band.alias("bucket")).distinct()
    open_rows = saved(open_rows, "bag-bands")
    shared = open_rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = open_rows.join(broadcast_if_small(shared.select("bucket")), "bucket", "left_semi").select("node").distinct()
    texts = saved(_texts(named, nodes.join(broadcast_if_small(met), "node", "left_semi")), "bag-texts")

    def finer(left: DataFrame) -> DataFrame:
        """Buckets of the wanted nodes by all FINE choices of slots."""
        rows = signed.select("node", "signature").join(broadcast_if_small(left), "node", "left_semi")
        choices = np.random.default_rng(SLOTS).permuted(np.tile(np.arange(SLOTS), (FINE, 1)), axis=1)[:, :FINE_ROWS]
        buckets = F.array(
            *(F.xxhash64(F.lit(-1 - i), *(F.get("signature", F.lit(int(k))) for k in own)) for i, own in enumerate(choices))
        )
        return rows.select("node", F.explode(buckets).alias("bucket")).distinct()

    sizes = signed.select("node", F.col("shingles").alias("size")).dropDuplicates(["node"])
    signature = signed.select("node", "signature")

    def likely(pairs: DataFrame) -> DataFrame:
        """Those pairs whose signatures agree in many slots."""
        nodes = pairs.select("node").union(pairs.select("leader")).distinct()
        own = broadcast_if_small(saved(signature.join(broadcast_if_small(nodes), "node").dropDuplicates(["node"]), "bag-likely"))
        other = own.select(F.col("node").alias("leader"), F.col("signature").alias("_signature"))
        agree = F.aggregate(
            F.zip_with("signature", "_signature", lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, same: n + same
        )
        return pairs.join(own, "node").join(other, "leader").filter(agree >= LIKELY).select("node", "leader")

    def apart(pairs: DataFrame, similarity: float) -> DataFrame:
        return _fronts(pairs, texts, similarity)

    links = linked(open_rows, lambda pairs: _overlaps(pairs, texts), similarity, sizes, finer, likely, apart)
    return class_ids(signed.select("doc_id", "node"), nodes, links)


def _texts(named: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the wanted nodes, each from the row with its least id."""
    wanted = saved(wanted.withColumnRenamed("node", "_node"), "bag-wanted")
    rows = named.join(
        broadcast_if_small(wanted), (named["node"] == wanted["_node"]) & named["doc_id"].eqNullSafe(wanted["least"])
    )
    return rows.select("node", "text").dropDuplicates(["node"])


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    other = texts.select(F.col("node").alias("leader"), F.col("text").alias("leader_text"))
    return pairs.join(texts, "node").join(other, "leader").select("node", "leader", "text", "leader_text")


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, pa.Scalar, np.ndarray, int, int]]:
    """Of each row of ``_with_texts`` node, leader, the elements that part their bags, and the sizes of both bags."""
    last, bag = None, None
    for batch in batches:
        for node, leader, a, b in zip(*(batch[c] for c in ("node", "leader", "text", "leader_text"))):
            if leader != last:
                last, bag = leader, _bag(b.as_py())
            own = _bag(a.as_py())
            yield node, leader, parting(own, bag), int(own[1].sum()), int(bag[1].sum())


def _fronts(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The first elements that part each node's bag from its leader's, rare ones first, for ``linking._sharing``.

    ``place`` counts the elements before; ``indexed`` ones are those by which a node with a smaller gap may meet one with a larger.
    Elements are dealt by hash in packed blocks, and only those that two nodes or more have beside one leader become rows.
    Which elements are rare is counted by slots of their hashes, so the counts have one size for any number of texts.
    An element that one text has alone beside its leader brings nobody together, so it is not counted: what is sent
    grows with what texts share. The counts choose an order and no result.
    """
    pairs = saved(pairs, "bag-apart")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = np.zeros(1 << OFTEN_BITS, np.int64), 0

        def passing() -> Iterator[tuple]:
            nonlocal total
            for gap in _gaps(batches):
                total += min(len(gap[2]), _reach(len(gap[2]), *gap[3:], similarity)[0])
                yield gap

        for slot in _by_leader(passing()):
            slot, n = np.unique(slot, return_counts=True)
            sums[slot[n > 1]] += n[n > 1]
        used = np.flatnonzero(sums)
        slots, n = np.append(used, ALL).astype(np.int32), np.append(sums[used], total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n)], names=["slot", "n"])

    counted = _with_texts(pairs, texts).sortWithinPartitions("leader").mapInArrow(count, "slot int, n long")
    counted = saved(counted.groupBy("slot").agg(F.sum("n").alias("n")), "bag-often").toArrow()
    slot, n = counted["slot"].to_numpy(), counted["n"].to_numpy()
    often = np.zeros(1 << OFTEN_BITS, np.int32)
    often[slot[slot != ALL]] = np.minimum(n[slot != ALL], 2**31 - 1)
    shared = pairs.sparkSession.sparkContext.broadcast(often)
    buckets = 1 + int(n[slot == ALL].sum()) // TOGETHER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for node, leader, element, *sizes in _gaps(batches):
            held.append((node.as_py(), leader.as_py(), len(element), *front(element, *sizes, similarity, shared.value)))
            size += len(held[-1][3])
            if size >= TOGETHER:
                yield packed_fronts(held, buckets)
                held, size = [], 0
        if size:
            yield packed_fronts(held, buckets)

    packed = _with_texts(pairs, texts).mapInArrow(run, "bucket int, packed binary")
    schema = "node binary, leader binary, element long, place long, gap long, indexed boolean"
    return packed.repartitionById(buckets, F.col("bucket")).mapInArrow(_meeting, schema)


def packed_fronts(fronts: list[tuple[bytes, bytes, int, np.ndarray, np.ndarray]], buckets: int) -> pa.RecordBatch:
    """One row a bucket of ``fronts`` (node, leader, gap, elements, indexed); an element and leader are in one bucket always."""
    sizes = np.array([len(f[3]) for f in fronts])
    rows = np.zeros(sizes.sum(), _FRONT)
    names = np.frombuffer(b"".join(f[0] + f[1] for f in fronts), np.uint64).reshape(-1, 4)
    rows["names"] = np.repeat(names, sizes, axis=0)
    rows["gap"] = np.repeat([f[2] for f in fronts], sizes)
    rows["element"] = np.concatenate([f[3] for f in fronts])
    rows["indexed"] = np.concatenate([f[4] for f in fronts])
    rows["place"] = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    of = (_met_by(rows) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(of, kind="stable")
    rows, of = rows[order], of[order]
    heads = np.flatnonzero(np.diff(of, prepend=-1))
    packed = [p.tobytes() for p in np.split(rows, heads[1:])]
    return pa.RecordBatch.from_arrays([pa.array(of[heads]), pa.array(packed, pa.binary())], names=["bucket", "packed"])


def _met_by(rows: np.ndarray) -> np.ndarray:
    """A hash of leader and element."""
    leader = rows["names"][:, 2:]
    return mix(rows["element"].view(np.uint64) ^ mix(leader[:, 0] ^ mix(leader[:, 1])))


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``packed_fronts`` but for elements that one node has alone beside its leader, which bring nobody together.

    A partition has whole buckets. Hashes that clash leave a row too many, which meets nobody.
    """
    parts = [np.frombuffer(raw.as_py(), _FRONT) for batch in batches for raw in batch["packed"]]
    if not parts:
        return
    rows = np.concatenate(parts)
    parts.clear()
    _, at, times = np.unique(_met_by(rows), return_inverse=True, return_counts=True)
    rows = rows[times[at] > 1]
    for part in (rows[i : i + ELEMENTS // 16] for i in range(0, len(rows), ELEMENTS // 16)):
        names = [np.ascontiguousarray(part["names"][:, k : k + 2]).tobytes() for k in (0, 2)]
        columns = [pa.Array.from_buffers(pa.binary(16), len(part), [None, pa.py_buffer(n)]).cast(pa.binary()) for n in names]
        columns += [pa.array(part[c].astype(np.int64)) for c in ("element", "place", "gap")] + [pa.array(part["indexed"].copy())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "leader", "element", "place", "gap", "indexed"])


def parting(a: Bag, b: Bag) -> np.ndarray:
    """The elements that one of two bags has and the other lacks; the k-th of equal shingles is an element of its own."""
    shingle = np.union1d(a[0], b[0])
    n, m = np.zeros((2, len(shingle)), np.int64)
    n[np.searchsorted(shingle, a[0])] = a[1]
    m[np.searchsorted(shingle, b[0])] = b[1]
    more = np.abs(n - m)
    at = np.repeat(np.arange(len(shingle)), more)
    k = np.minimum(n, m)[at] + np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
    return mix(shingle[at] + (k.astype(np.uint64) << np.uint64(48))).view(np.int64)


def _by_leader(gaps: Iterator[tuple]) -> Iterator[np.ndarray]:
    """Slots of the elements that part texts from one leader, at most some ELEMENTS at a time."""
    last, held, size = None, [], 0
    for _, leader, element, _, _ in gaps:
        if held and (leader != last or size >= ELEMENTS):
            yield np.concatenate(held)
            held, size = [], 0
        last, size = leader, size + len(element)
        held.append(_slot(element))
    if held:
        yield np.concatenate(held)


def _slot(element: np.ndarray) -> np.ndarray:
    return (element.view(np.uint64) >> np.uint64(64 - OFTEN_BITS)).astype(np.int64)


def _reach(gap: int, size: int, size_of_leader: int, similarity: float) -> tuple[int, float]:
    """How many first elements of a gap may bring a node to another, and up to which place with a larger gap."""
    r = (1 - similarity) / (1 + similarity)
    last = r * (size + size / similarity) + 1e-6
    half = last / 2
    if gap <= r * (size + size_of_leader):
        # Similar to the leader itself: only a text that is not may be of another class.
        last = min(last, (gap - r * (size_of_leader - size)) / 2 + 1e-6)
    return max(0, int(np.floor(last)) + 1), half


def front(element: np.ndarray, size: int, size_of_leader: int, similarity: float, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of ``element``, the rarest ones by ``often`` a slot, and which of them are indexed."""
    reach, half = _reach(len(element), size, size_of_leader, similarity)
    first = element[np.lexsort((element, often[_slot(element)]))][:reach]
    return first, np.arange(len(first)) <= half


def _overlaps(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` with ``overlap``, their exact weighted Jaccard similarity."""
    joined = _with_texts(pairs, texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in batches:
            overlaps = []
            for leader, a, b in zip(batch["leader"], batch["text"], batch["leader_text"]):
                if leader != last:
                    last, bag = leader, _bag(b.as_py())
                overlaps.append(overlap(_bag(a.as_py()), bag))
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["leader"], pa.array(overlaps, pa.float64())], names=["node", "leader", "overlap"]
            )

    return joined.mapInArrow(run, "node binary, leader binary, overlap double")


def _bag(text: str) -> Bag:
    ((_, hashes, bounds),) = chunks([text])
    return shingle_bags(hashes, bounds)[1:]


def overlap(a: Bag, b: Bag) -> float:
    """Weighted Jaccard similarity of two bags of sorted elements and weights; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / max(1, int(a[1].sum()) + int(b[1].sum()) - common)
