import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import bag_minhash as bag
from cellweave.llm import queries, tokens


def shingles(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def overlap(a, b):
    a, b = shingles(a), shingles(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def plain(rows):
    """Classes by comparing all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a or "") == (rows[j][1] or "") or overlap(a, rows[j][1]) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, shingles int")
    return sorted(((r["doc_id"], r["class_id"]) for r in bag.classes(df).collect()), key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    return [" ".join(word() for _ in range(rng.choice([3, 8, 60, 200]))) for _ in range(n)], rng, word


def test_tokens_equal_split():
    for text in ("", "  ", "a", " A b\tA\n é É ", "x" * 5000, "a b " * 1000):
        (chunk,) = tokens.chunks([text])
        words = "".join(c.lower() if c.isascii() else c for c in text).split()
        assert len(chunk[1]) == len(words)
        assert len(set(chunk[1].tolist())) == len(set(words))
    assert np.array_equal(next(tokens.chunks(["q a b"]))[1][1:], next(tokens.chunks(["A B"]))[1])


def test_long_text_is_cut_at_spaces(monkeypatch):
    text = "alpha beta gamma delta " * 50
    whole = next(tokens.chunks([text]))[1]
    monkeypatch.setattr(tokens, "CHUNK", 64)
    assert np.array_equal(next(tokens.chunks([text]))[1], whole)
    assert sum(len(b) - 1 for _, _, b in tokens.chunks(["a b", None, text, "", "c"])) == 5


def test_pieces_are_hashed_as_a_whole(monkeypatch):
    made = [" ".join(texts(5, 20)[0]), None, "", "a", "alpha beta " * 30, " lead and tail ", "\t"]
    whole = next(tokens.chunks(made))
    for size in (1, 16, 64, 300):
        monkeypatch.setattr(tokens, "PIECE", size)
        (parts,) = tokens.chunks(t for t in made)
        assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_memory_of_hashing_is_that_of_a_piece(monkeypatch):
    """Two megabytes of texts are hashed without arrays of 8 bytes for each of their bytes."""
    made = ["alpha beta gamma delta " * 90] * 900
    monkeypatch.setattr(tokens, "_powers", {})
    tracemalloc.start()
    try:
        assert sum(len(h) for _, h, _ in tokens.chunks(made)) == 4 * 90 * 900
        assert tracemalloc.get_traced_memory()[1] < 24 << 20
    finally:
        tracemalloc.stop()


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    gaps = []
    for _ in range(150):
        e = np.sort(rng.integers(0, 2**48, 40).astype(np.uint64))
        a = rng.integers(0, 9, 40)
        b = np.clip(a + rng.integers(-2, 3, 40), 0, None)
        s = bag.bag_signatures(np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), np.r_[e[a > 0], e[b > 0]], np.r_[a[a > 0], b[b > 0]], 2)
        gaps.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(gaps)) < 0.015 and np.std(gaps) < 0.08


def test_exact_overlap():
    a, b = "a b c d e f g A B C D E", "a b c d e f x a b c d e"
    assert bag.overlap(bag._bag(a), bag._bag(b)) == pytest.approx(overlap(a, b))


def test_classes_equal_brute_force(spark):
    made, rng, word = texts(3, 40)
    rows = [(i, t) for i, t in enumerate(made)]
    for i in range(60):
        words = made[i % 40].split()
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = word()
        rows.append((100 + i, " ".join(words)))
    assert run(spark, rows) == plain(rows)


def test_chain_of_edits(spark):
    _, rng, word = texts(4, 1)
    words = [word() + str(i) for i in range(200)]
    rows = []
    for i in range(25):
        rows.append((50 - i, " ".join(words)))
        for _ in range(3):
            words[rng.randrange(200)] = word() + "z"
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "   "), (4, "   "), (5, "one two"), (6, "One  two"), (7, long), (8, long + " tail"), (None, long), (9, "x y z"), (9, "x y z"), (9, "p q r"), (None, "alone")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []


def test_one_large_group(spark):
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:150] + [f"n{i}"] + base[150:])) for i in range(400)]
    assert {c for _, c in run(spark, rows)} == {0}


def test_query(spark, folder, given):
    rows = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    got = queries.queries()["op10_bag_minhash"](spark, folder).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == plain(rows)


def test_second_edits_beside_a_large_star(spark):
    """A is near its source D; B is an edit of A, near A and not D. D leads where A and B meet."""
    _, rng, word = texts(9, 1)
    base = [word() + str(i) for i in range(300)]
    rows = [(1000 + i, " ".join(base + [f"tail{i}"])) for i in range(60)]
    for i in range(24):
        own = list(base)
        own[20] = f"first{i}"
        rows.append((2000 + i, " ".join(own)))
        for k in range(6):
            own[45 + 40 * k] = f"second{i}x{k}"
        rows.append((3000 + i, " ".join(own)))
    by = dict(rows)
    far = [overlap(by[3000 + i], by[1000]) for i in range(24)]
    assert max(far) < 0.8 <= min(overlap(by[3000 + i], by[2000 + i]) for i in range(24))
    assert run(spark, rows) == plain(rows)


def test_links_of_settled_nodes(spark):
    """In the one bucket of all, b is too far from its leader d, and near a, which d settles."""
    from cellweave.llm import linking

    near = {frozenset("ad"): 0.96, frozenset("ab"): 0.818, frozenset("bd"): 0.786}
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1), ("d", 2), ("e", 2), ("d", 3), ("e", 3)], "node string, bucket int")
    sizes = rows.select("node").distinct().selectExpr("node", "100 AS size")
    table = spark.createDataFrame([(x, y, near.get(frozenset(x + y), 0.9)) for x in "abde" for y in "abde"], "node string, leader string, overlap double")
    links = linking.linked(rows, lambda pairs: pairs.join(table, ["node", "leader"]), 0.8, sizes)
    assert frozenset("ab") in {frozenset((r["node"], r["leader"])) for r in links.collect()}


def near_copies(seed, n, edits):
    """``n`` copies of one text, each with as many edits of its own as a choice of ``edits``, and edits of some of the copies."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(300), rng.choice(edits)):
            own[at] = f"e{i}x{at}"
        rows.append((i + 1, " ".join(own)))
        if i % 4 == 0:
            own[rng.randrange(300)] = f"f{i}"
            rows.append((10_000 + i, " ".join(own)))
    return rows


def test_large_group_that_its_leader_does_not_settle(spark):
    """Classes are those of all pairs, where most copies are too far from the text they were made from, and edits of copies are near."""
    rows = near_copies(6, 160, [2, 7, 8, 9, 10, 14])
    assert run(spark, rows) == plain(rows)


def test_comparisons_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    """Copies with edits of their own share nothing beyond the text they were made from."""
    judged = []
    overlaps = bag._overlaps

    def counting(pairs, texts):
        judged.append(pairs.count())
        return overlaps(pairs, texts)

    monkeypatch.setattr(bag, "_overlaps", counting)
    rows = near_copies(7, 400, [8, 9, 10])
    run(spark, rows)
    assert sum(judged) < 20 * len(rows)


def test_elements_of_one_text_are_not_counted(spark, monkeypatch):
    """What is sent to tell often elements grows with what texts share, not with the edits that each has alone."""
    sent = {}
    saved = bag.saved

    def keeping(df, name):
        sent[name] = saved(df, name)
        return sent[name]

    monkeypatch.setattr(bag, "saved", keeping)
    rows = [r for r in near_copies(7, 400, [8, 9, 10]) if r[0] < 10_000]
    run(spark, rows)
    n = [r["n"] for r in sent["bag-often"].collect()]
    assert min(n) > 1 and len(n) < 10 * len(rows)


def test_elements_of_one_text_make_no_rows(spark):
    """Of the elements that part texts from a leader only those come out that two texts or more have."""
    rows = near_copies(7, 40, [8, 9, 10])
    named = [(f"{i:016d}".encode(), text) for i, text in rows]
    pairs = spark.createDataFrame([(n, named[0][0]) for n, _ in named[1:]], "node binary, leader binary")
    got = bag._fronts(pairs, spark.createDataFrame(named, "node binary, text string"), 0.8).collect()
    times = Counter(r["element"] for r in got)
    assert got and min(times.values()) > 1 and len({(r["node"], r["element"]) for r in got}) == len(got)


def test_packed_fronts_are_those_that_meet():
    rng = np.random.default_rng(4)
    fronts, plain = [], []
    for i in range(60):
        node, leader = (bytes(rng.integers(0, 256, 14).astype(np.uint8)) + b"\0\0" for _ in "ab")
        leader = b"\0" * 15 + bytes([i % 3])
        element = rng.choice(np.arange(-300, 300), rng.integers(0, 12), replace=False)
        indexed = np.arange(len(element)) < 5
        fronts.append((node, leader, 100 + i, element, indexed))
        plain += [(node, leader, e, place, 100 + i, f) for place, (e, f) in enumerate(zip(element.tolist(), indexed.tolist()))]
    times = Counter(r[1:3] for r in plain)
    want = sorted(r for r in plain if times[r[1:3]] > 1)
    for buckets in (1, 7):
        by = {}
        for part in (fronts[:20], fronts[20:]):
            batch = bag.packed_fronts(part, buckets)
            assert batch.num_rows <= buckets
            for b, packed in zip(batch["bucket"].to_pylist(), batch["packed"].to_pylist()):
                by.setdefault(b, []).append(packed)
        batches = (bag.pa.RecordBatch.from_pydict({"packed": packed}) for packed in by.values())
        got = [tuple(r.values()) for b in batches for out in bag._meeting([b]) for r in out.to_pylist()]
        assert sorted(got) == want and 0 < len(want) < len(plain)


def test_components(spark, monkeypatch):
    from cellweave.llm import linking

    tables = []
    saved = linking.saved
    monkeypatch.setattr(linking, "saved", lambda df, name: tables.append(name) or saved(df, name))
    rng = random.Random(3)
    stars = [(f"n{i}", f"a{i % 5}") for i in range(40)]
    for links, n in ((stars, 1), ([], 1), ([(f"n{rng.randrange(90)}", f"n{rng.randrange(90)}") for _ in range(70)], None), ([(f"p{i:02}", f"p{i + 1:02}") for i in range(30)], None)):
        links = [x for x in links if x[0] != x[1]]
        root = {x: x for link in links for x in link}
        for _ in range(len(root)):
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        tables.clear()
        got = {r["node"]: r["root"] for r in linking.components(spark.createDataFrame(links, "node string, leader string")).collect()}
        assert got == {x: r for x, r in root.items() if x != r}
        assert n is None or len(tables) == n


def test_first_elements_of_similar_texts_meet():
    """Of two similar bags, one of which is not similar to the leader, an element that both gaps begin with is found."""
    rng = np.random.default_rng(8)
    met = 0
    for _ in range(1500):
        e = np.sort(rng.integers(0, 2**48, 120).astype(np.uint64))
        leader = rng.integers(0, 3, 120)
        x = np.where(rng.random(120) < rng.uniform(0, 0.4), rng.integers(0, 3, 120), leader)
        y = np.where(rng.random(120) < rng.uniform(0, 0.2), rng.integers(0, 3, 120), x)
        leader, x, y = ((e[w > 0], w[w > 0]) for w in (leader, x, y))
        if bag.overlap(x, y) < 0.8 or max(bag.overlap(x, leader), bag.overlap(y, leader)) >= 0.8 and min(bag.overlap(x, leader), bag.overlap(y, leader)) >= 0.8:
            continue
        often = rng.integers(0, 4, 1 << bag.OFTEN_BITS)
        gaps = sorted(((bag.parting(v, leader), v[1].sum()) for v in (x, y)), key=lambda g: -len(g[0]))
        p, q = (len(g) for g, _ in gaps)
        (a, _), (b, indexed) = (bag.front(*g, leader[1].sum(), 0.8, often) for g in gaps)
        c = (p + q - (x[1].sum() + y[1].sum()) / 9) / 2
        shared = [(p - m, q - n) for m in range(len(a)) for n in range(len(b)) if a[m] == b[n] and indexed[n]]
        assert any(min(s) >= c - 1e-6 for s in shared)
        met += 1
    assert met > 100
