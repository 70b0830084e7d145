import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cellweave.functions.events import has_keys, millis_timestamp, parsed_with_keys, tracks
from cellweave.sources.events import (
    MESSAGE,
    REQUIRED_FIELDS,
    message_puts,
    parse_messages,
    read_stream,
    sample,
    tracked,
)

FULL = {
    "id": 1,
    "id_str": "1",
    "text": "héllo #X",
    "timestamp_ms": "1424974260658",
    "lang": "en",
    "user": {"id": 7, "id_str": "7"},
    "place": {"country": "Perú"},
    "entities": {"hashtags": [{"text": "X"}, {"text": None}, {"text": "é1"}]},
}


def lines(spark, *messages):
    rows = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    return spark.createDataFrame(rows, "value STRING")


def parsed(spark, *messages):
    return [r.asDict() for r in parse_messages(lines(spark, *messages)).collect()]


def test_full_message(spark):
    (m,) = parsed(spark, FULL)
    assert m["row_key"] == "1" and m["text"] == "hllo #X" and m["country"] == "Per"
    assert m["hashtags"] == ["X", "", "1"] and m["user_id"] == "7"
    assert m["ts"].microsecond == 658000


@pytest.mark.parametrize("missing", ["id", "text", "timestamp_ms", "user"])
def test_required_field_missing(spark, missing):
    assert parsed(spark, {k: v for k, v in FULL.items() if k != missing}) == []


def test_other_lines_are_skipped(spark):
    assert parsed(spark, {"delete": {"id": 1}}, "{broken", "", "[1]", "null") == []


@pytest.mark.parametrize(
    "change,column,value",
    [
        ({"text": None}, "text", ""),
        ({"text": ""}, "text", ""),
        ({"place": None}, "country", ""),
        ({"place": {}}, "country", ""),
        ({"user": None}, "user_id", None),
        ({"entities": {"hashtags": []}}, "hashtags", []),
        ({"entities": None}, "hashtags", []),
        ({"id_str": None}, "row_key", "1"),
        ({"timestamp_ms": "soon"}, "ts", None),
    ],
)
def test_optional_fields(spark, change, column, value):
    (m,) = parsed(spark, FULL | change)
    assert m[column] == value


def test_message_cells(spark):
    rows = message_puts(parse_messages(lines(spark, FULL | {"user": None}))).collect()
    got = {(r["family"], r["qualifier"]): r["value"] for r in rows}
    assert got == {
        ("general", "text"): "hllo #X",
        ("general", "timestamp"): "1424974260658",
        ("general", "lang"): "en",
        ("general", "country"): "Per",
        ("hashtags", ""): "X,,1",
    }


@pytest.mark.parametrize(
    "phrases,text,found",
    [
        (["storm"], "The STORM!", True),
        (["storm"], "a #storm", True),
        (["storm"], "storms", False),
        (["#storm"], "storm", False),
        (["blue storm"], "storm, so blue", True),
        (["blue storm"], "storm", False),
        (["x", "storm"], "storm", True),
        (["סופה"], "זו סופה", True),
        ([], "storm", False),
        ([" "], "storm", False),
    ],
)
def test_tracks(spark, phrases, text, found):
    df = spark.createDataFrame([(text,)], "text STRING")
    assert df.select(tracks(F.col("text"), phrases)).collect()[0][0] is found


def plain_tracks(text, phrases):
    """Every word of some phrase is a token, or a plain one's hashtag or mention is."""
    found = set(re.split(r"[^\w#@]+", text.lower()))
    for words in (p.lower().split() for p in phrases):
        if words and all(w in found or (w[0] not in "#@" and {f"#{w}", f"@{w}"} & found) for w in words):
            return True
    return False


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_many_phrases_equal_the_plain_test(spark, seed):
    rnd = random.Random(seed)
    words = ["a", "b", "cc", "#a", "@b", "##a", "#", "@#b", "é", "d_1", "x"]
    texts = [rnd.choice([" ", ", "]).join(rnd.choice(words + ["zz"]) for _ in range(rnd.randrange(6))) for _ in range(150)]
    phrases = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(4))) for _ in range(rnd.choice([1, 5, 12]))]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = df.select("text", tracks(F.col("text"), phrases).alias("hit")).collect()
    assert [(r["text"], r["hit"]) for r in got] == [(t, plain_tracks(t, phrases)) for t in texts]


def test_a_thousand_phrases_split_the_text_once(spark):
    phrases = [f"word{i} other{i % 7}" for i in range(1000)]
    df = spark.createDataFrame([("so Word77, and OTHER0",), ("word77 other1",), (None,)], "text STRING")
    hit = df.select(tracks(F.col("text"), phrases).alias("hit"))
    assert [r["hit"] for r in hit.collect()] == [True, False, None]
    assert hit._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 1


def test_presence_parses_once(spark):
    rows = ['{"a": null, "b": 1, "a": 2}', '{"a": 1}', "[]", "{", "", None, '{"b": {}, "a": []}']
    df = spark.createDataFrame([(r,) for r in rows], "j STRING")
    found = df.select(has_keys(F.col("j"), ["a", "b"]).alias("x"))
    assert [r["x"] for r in found.collect()] == [True, False, None, None, None, None, True]
    assert df.filter(has_keys(F.col("j"), ["a", "b"])).count() == 2


ODD = [
    {"id": "12", "text": 5, "timestamp_ms": 5, "user": None},
    {"id": 1.5, "text": {"b": 1, "a": 2}, "timestamp_ms": "x", "user": "s"},
    {"id": 1, "text": None, "timestamp_ms": None, "user": None, "entities": {"hashtags": [1, {"text": "k"}]}},
    {"id": 10**20, "text": True, "timestamp_ms": 1.5, "user": {"id": "a", "id_str": 3}, "place": []},
    '{"id": 1, "id": 2, "text": "a", "timestamp_ms": "1", "user": {"id": 3, "id": 4}}',
    '{"id": 1, "text": "a", "timestamp_ms": "1", "user": {}} junk',
    '{"id": 1, "text": "a", "timestamp_ms": "1", "user": {}, junk',
    '[{"id": 1, "text": "a", "timestamp_ms": "1", "user": {}}]',
    '{"place": {"id": 1, "text": "a", "timestamp_ms": "1", "user": {}}}',
    '{"m": [], "id": null, "text": null, "timestamp_ms": null, "user": null',
    "{'id': 1, 'text': 'a', 'timestamp_ms': '1', 'user': {}}",
    '{"ID": 1, "text": "a", "timestamp_ms": "1", "user": {}}',
    " ",
]


def test_one_parse_gives_what_two_give(spark):
    df = lines(spark, FULL, *[{k: v for k, v in FULL.items() if k != gone} for gone in FULL], *ODD)
    once = df.select(F.explode(parsed_with_keys(F.col("value"), MESSAGE, REQUIRED_FIELDS)).alias("m"))
    twice = df.filter(has_keys(F.col("value"), REQUIRED_FIELDS)).select(F.from_json("value", MESSAGE).alias("m"))
    assert once.count() == 12
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_a_condition_does_not_parse_again(spark):
    messages = parse_messages(lines(spark, FULL), keep=tracked("x", text="m.text", lang="m.lang"))
    plan = messages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert [r["id"] for r in messages.collect()] == [1]


def test_tracked_splits_at_commas_and_tests_the_language(spark):
    df = spark.createDataFrame([("a", "en"), ("b", "fr"), ("b", "he"), ("c", "en")], "text STRING, lang STRING")
    assert {tuple(r) for r in df.filter(tracked("a,b")).collect()} == {("a", "en"), ("b", "he")}


def test_sample_is_the_same_in_batch_and_stream(spark, tmp_path):
    spark.range(2000).select(F.col("id").cast("string").alias("value")).write.text(f"{tmp_path}/in")
    stream = sample(read_stream(spark, f"{tmp_path}/in", max_files=1), 0.2, "value", languages=None)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(
        availableNow=True
    ).start(f"{tmp_path}/out").awaitTermination()
    got = {r[0] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = sample(spark.read.text(f"{tmp_path}/in"), 0.2, "value", languages=None)
    assert got == {r[0] for r in batch.collect()}
    assert 300 < len(got) < 500


def test_millis(spark):
    df = spark.createDataFrame([("0",), ("x",), (None,)], "t STRING")
    got = [r[0] for r in df.select(millis_timestamp(F.col("t")).cast("long")).collect()]
    assert got == [0, None, None]
