import hashlib
import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cellweave.llm import conversation_repair as repair
from cellweave.llm import queries

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def faults(rows):
    """First faults of rows (turn, role, text) that stand in order."""
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(repair.SPACES)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("none" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain(rows, whole=True):
    """Counts, cost, audit and repaired lines of one conversation, by trying all edits.

    Of the paths that give the same role initials so far, the cheapest with the least audit leads on; unless ``whole``, only
    the last initial is looked at, for long conversations.
    """
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    marks = faults(rows)
    paths = {"": (0, "", ())}

    def inserted(paths):
        out = dict(paths)
        for _ in range(2):
            for said, (cost, audit, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    offer(out, said, role[0], (cost + 3, audit + "I", (*lines, f"{role}:")))
        return out

    def offer(out, said, more, path):
        if not re.fullmatch(r"s?(ua)*u?", said + more) if whole else more and said + more not in ("s", "u", "su", "ua", "au"):
            return  # can no longer become legal
        said = said + more if whole else (said + more)[-1:]
        if said not in out or path < out[said]:
            out[said] = path

    for (_, role, text), fault in zip(rows, marks):
        after = {}
        for said, (cost, audit, lines) in inserted(paths).items():
            offer(after, said, "", (cost + 4, audit + "D", lines))
            if fault in ("none", "truncated"):
                more = 3 * (fault == "truncated")
                offer(after, said, role[:1] or "?", (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    offer(after, said, name[0], (cost + more + 3, audit + "R", (*lines, f"{name}:{text}")))
        paths = after
    ends = [p for s, p in inserted(paths).items() if (GRAMMAR.fullmatch(s) if whole else s in ("", "a"))]
    cost, audit, lines = min(ends)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, list(lines))


def check(spark, conversations, extra=None):
    rows = [(c, *r) for c, own in conversations.items() for r in own]
    turns = spark.createDataFrame(rows, SCHEMA)
    for name, value in (extra or {}).items():
        turns = turns.withColumn(name, value)
    planned = repair.plans(repair.signatures(turns))
    got = {r["conv_id"]: r for r in repair.digests(turns, planned).collect()}
    lines = {}
    for r in repair.repaired(turns, planned).orderBy("place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert set(got) == {c for c, own in conversations.items() if own}
    for conv, own in conversations.items():
        if own:
            *want, text = plain(own, len(own) < 9)
            assert [got[conv][c] for c in COUNTS] == want, own
            assert lines.get(conv, []) == text
            assert got[conv]["repaired_sha256"] == hashlib.sha256("\n".join(text).encode()).hexdigest()


def test_random_conversations_equal_brute_force(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "User", "tool", "", "uncle"]
    texts = ["Yes.", "No!", "cut", " \t", "", "Why?\n", "é. ", "end.x"]
    made = {}
    for conv in range(300):
        turns = [rng.choice([None, 0, 1, 2, 3, 5, 9]) for _ in range(rng.randint(1, 7))]
        made[conv] = [(t, rng.choice(roles[:3] if conv % 2 else roles), rng.choice(texts)) for t in turns]
    check(spark, made)


def test_nulls_repeats_and_clashing_columns(spark):
    own = [(None, None, None), (0, "user", "a."), (0, "user", "a."), (0, "user", "a."), (3, "assistant", None), (3, None, "b")]
    extra = {n: F.lit(1) for n in ("signature", "rank", "copies", "digest", "audit", "letter", "first", "said", "place")}
    check(spark, {None: own, 1: own, 2: [(None, "user", "x.")] * 3}, extra)


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    planned = repair.plans(repair.signatures(turns))
    assert planned.count() == repair.digests(turns, planned).count() == repair.repaired(turns, planned).count() == 0


def test_long_conversation_over_many_ranges_and_a_long_text(spark):
    rng = random.Random(6)
    long = [(i, ("user", "assistant")[i % 2], f"text {i}" + rng.choice([".", "", "!"])) for i in range(600)]
    for i in rng.sample(range(600), 150):
        long[i] = (i, rng.choice(["user", "assistant", "system"]), rng.choice(["", "same.", "other"]))
    long[7] = (7, "user", "word " * 400_000 + ".")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        check(spark, {1: long, 2: long[5:], 3: long[:400], None: long[300:]})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_every_node_is_made_once():
    rng = random.Random(7)
    letters = [chr(repair._FIRST + i) for i in range(16)]
    signatures = sorted({"".join(rng.choice(letters[4:8]) for _ in range(rng.randint(1, 6))) for _ in range(500)}, key=lambda s: s[::-1])
    made, plain_node = [], repair.Automaton._node

    class Counting(repair.Automaton):
        def _node(self, letter, ahead):
            made.append(letter)
            return plain_node(self, letter, ahead)

    automaton = Counting()
    found = [automaton.best(s) for s in signatures]
    assert len(made) == len({s[i:] for s in signatures for i in range(len(s))})
    assert found == [repair.Automaton().best(s) for s in signatures]


def test_common_prefix():
    for a, b in itertools.product(["", "a", "ab", "abc", "abd", "b", "abcabc"], repeat=2):
        want = len([x for x in itertools.takewhile(lambda p: p[0] == p[1], zip(a, b))])
        assert repair._common(a, b) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_its_sql_on_odd_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, -7, *range(60)]:
        turns = rng.sample([None, *range(-2, 12)], rng.randint(1, 8))
        rows += [(conv, t, rng.choice([None, "user", "assistant", "system", "x"]), rng.choice([None, "", "Yes.", "No", "\x0b", "a?b", "Yes. "])) for t in turns]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = queries.queries()["op11_conversation_repair"](spark, str(tmp_path))
    want = con.sql(queries.oracle_sql()["op11_conversation_repair"]).fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert len(want) == 62
