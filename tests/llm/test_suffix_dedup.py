import hashlib
import random

import numpy as np
import pytest

from cellweave.llm import queries, suffix_dedup

SCHEMA = "doc_id long, text string, node int, places string, rank int"


def plain(docs, length=suffix_dedup.LENGTH):
    rank = lambda i: suffix_dedup.NO_ID if i is None else i
    raws = [(rank(i), (t or "").encode()) for i, t in docs]
    least = {}
    for i, raw in raws:
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            least[w] = min(i, least.get(w, i))
    out = []
    for (doc_id, _), (i, raw) in zip(docs, raws):
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if least[raw[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, docs):
    rows = spark.createDataFrame([(*d, 1, "p", 0) for d in docs], SCHEMA)
    out = []
    for r in suffix_dedup.removed(rows).collect():
        gone = sum(s["end"] - s["start"] for s in r["spans"])
        assert gone == r["n_bytes"] - len(r["kept"])
        out.append((r["doc_id"], r["n_bytes"], gone, len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    shared = [text(n) for n in (20, 49, 50, 51, 60, 120)]
    docs = [(i, text(rng.randint(0, 90)) + rng.choice(shared) + text(rng.randint(0, 60)) + rng.choice(shared)) for i in range(60)]
    docs += [(i, rng.choice(docs)[1]) for i in range(60, 70)] + [(i, "a" * rng.randint(40, 200)) for i in range(70, 76)]
    rng.shuffle(docs)
    return docs


def test_random_texts(spark):
    docs = made(1)
    assert run(spark, docs) == plain(docs)


def test_many_buckets(spark, monkeypatch):
    """Strings of many documents fill several buckets."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 150)
    docs = made(2) + [(200 + i, f"{i} " + "the same long passage in all of these documents, word for word") for i in range(60)]
    assert run(spark, docs) == plain(docs)


def test_odd_rows(spark):
    a, b = "x" * 50, "".join(map(str, range(60)))
    docs = [(None, b), (None, b), (5, b + a), (5, b + a), (5, a), (6, None), (7, ""), (8, a[:49]), (9, b), (9, b + "é"), (3, None)]
    assert run(spark, docs) == plain(docs)


def test_long_text(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(600_000))
    docs = [(1, long[700:9_000]), (2, long), (3, long[:1100] + "-" + long[1100:])]
    got = {r[0]: r[1:4] for r in run(spark, docs)}
    assert got == {1: (8_300, 0, 0), 2: (600_000, 8_300, 1), 3: (600_001, 600_000, 2)}


def test_parts_hold_the_same_suffixes():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abé ") for _ in range(rng.choice([0, 40, 60, 500, 3_000]))) for _ in range(40)] + [None, ""]

    def every(size):
        return sorted(row for part in suffix_dedup.suffixes(texts, size) for row in zip(*(c.tolist() for c in part[:5])))

    assert every(100) == every(1 << 20)


def test_bucket_of_a_suffix():
    rng = np.random.default_rng(5)
    columns = tuple(rng.integers(-3, 3, 300) for _ in range(3))
    splitters = sorted({tuple(int(c[i]) for c in columns) for i in range(0, 300, 9)})
    got = suffix_dedup._bucket_of(columns, splitters)
    assert got.tolist() == [sum(s < row for s in splitters) for row in zip(*map(np.ndarray.tolist, columns))]
    assert suffix_dedup._bucket_of(columns, []).tolist() == [0] * 300


def test_a_group_of_copies_in_several_tasks(spark, monkeypatch):
    """Near copies are dealt to tasks and blocks; none of these holds the first copy of all."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 400)
    monkeypatch.setattr(suffix_dedup, "TASK_BLOCKS", 1)
    words = " ".join(f"word{i}" for i in range(40))
    docs = [(500 - i, words.replace(f"word{i % 40}", f"other{i}")) for i in range(80)] + [(0, words[60:200])]
    assert run(spark, docs) == plain(docs)


def test_settled_anchors():
    whole = np.array([[7, 8, 7, 9, 9], [2, 2, 2, 3, 3]])
    assert suffix_dedup._settled(np.array([7, 8, 9, 7, 1]), whole).tolist() == [True, False, False, True, False]
    assert suffix_dedup._settled(np.array([7]), np.zeros((2, 0), np.int64)).tolist() == [False]


def test_parts_of_a_text_are_not_whole(spark, monkeypatch):
    """Copies of passages lie in different parts of long texts, and in short ones."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 3_000)
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    shared = [text(n) for n in (70, 90, 300, 7_000)]
    docs = [(i, text(rng.randint(0, 300)) + rng.choice(shared) + text(30)) for i in range(20)]
    long = text(suffix_dedup.PIECE + 20_000)
    docs += [(20, long + shared[2]), (7, shared[1] + long[-30_000:]), (30, long[:9_000] + shared[0]), (3, long[1_000:8_000])]
    assert run(spark, docs) == plain(docs)


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [0, 1, 10, 5_000])
def test_multikey_quicksort(n, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHORT", 40)
    rng = np.random.default_rng(n)
    columns = [rng.integers(0, 9, n), rng.integers(-5, 5, n), rng.integers(0, 30, n)]
    order = suffix_dedup.multikey_quicksort(columns)
    rows = list(zip(*columns))
    assert [rows[i] for i in order] == sorted(rows) and sorted(order) == list(range(n))


def test_query(spark, folder, given):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    got = queries.queries()["op2_suffix_dedup"](spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs)
