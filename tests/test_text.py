import pytest
from pyspark.sql import functions as F

from cellweave.functions import text as ft
from cellweave.operators import text as ot


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text STRING")


def apply(spark, fn, values):
    rows = column(spark, values).select(fn(F.col("text")).alias("x")).collect()
    return [r["x"] for r in rows]


def test_words_keep_empties(spark):
    assert apply(spark, ft.words, ["a  b ", "", " "]) == [["a", "", "b", ""], [""], ["", ""]]


def test_blank_is_control_characters_and_spaces(spark):
    values = ["", " ", "\t\n\r", "\x00\x1f", "a", " a ", " ", " "]
    assert apply(spark, ft.is_blank, values) == [True] * 4 + [False] * 4


def test_utf16_length_counts_surrogates(spark):
    assert apply(spark, ft.utf16_length, ["", "abc", "a😀é", "שלום"]) == [0, 3, 4, 4]


def test_ascii_only(spark):
    assert apply(spark, ft.ascii_only, ["naïve 😀 #x", "é", ""]) == ["nave  #x", "", ""]


def test_join_keeps_the_place_of_nulls(spark):
    df = spark.createDataFrame([(["a", None, "b"],), ([],)], "t ARRAY<STRING>")
    assert [r[0] for r in df.select(ft.join_texts(F.col("t"))).collect()] == ["a,,b", ""]


def test_bytes_round_trip(spark):
    assert apply(spark, lambda c: ft.from_bytes(ft.to_bytes(c)), ["é😀", ""]) == ["é😀", ""]
    assert apply(spark, ft.to_bytes, ["é"]) == [bytearray(b"\xc3\xa9")]
    df = spark.createDataFrame([(bytearray(b"a\xff"),)], "b BINARY")
    assert df.select(ft.from_bytes(F.col("b"))).collect()[0][0] == "a\ufffd"
    same = ft.to_bytes(F.col("b").cast("string"))
    assert df.select(same).collect()[0][0] == bytearray(b"a\xff")


def test_word_count(spark):
    df = column(spark, ["a b  a", None, "\t x \n", "  a", "b\u0001 B"])
    got = {r["word"]: r["cnt"] for r in ot.word_count(df).collect()}
    assert got == {"a": 3, "b": 1, "x": 1, " ": 1, "b\u0001": 1, "B": 1}


def test_blank_filter_runs_before_the_count(spark):
    plan = ot.word_count(column(spark, ["a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Filter")


def test_counts_are_stored_as_text(spark):
    counts = ot.word_count(column(spark, ["a a b"]))
    puts = ot.word_count_puts(counts, F.timestamp_millis(F.lit(5)))
    got = {(r["row_key"], r["family"], r["qualifier"], r["value"]) for r in puts.collect()}
    assert got == {("a", "words", "value", "2"), ("b", "words", "value", "1")}


@pytest.mark.parametrize("lines,total", [([], 0), (["ab", "", "😀"], 4)])
def test_total_length(spark, lines, total):
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    assert ot.total_length(df).collect()[0]["total_length"] == total
