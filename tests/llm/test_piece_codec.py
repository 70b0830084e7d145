import pytest
import sentencepiece

from cellweave.llm import piece_codec, queries

MODEL = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
ODD = ["", " ", "  ", " a", "a ", " a  b   ", "\n\t x", "🙂 é ▁ ▁▁x", "<s> </s> <0x41>", "日本語", "a\u0000b", "a" * 3000, "é" * 200, "word " * 5000, "<unk>"]


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("text", ODD)
def test_same_ids_and_text_as_the_other_library(theirs, text):
    tool = piece_codec.codec(MODEL)
    ids = tool.encode([text])[0].tolist()
    assert ids == theirs.encode(text) == (tool.tokenizer.encode(text).ids if text else [])
    assert tool.decode([ids]) == [theirs.decode(ids)]


def test_verification_of_whole_texts(theirs):
    tool = piece_codec.Codec(MODEL, verify=True)
    texts = [*ODD, "a b", "b ab"]
    ids = tool.encode(texts)
    back = tool.decode([i.tolist() for i in ids])
    assert all(tool.agreed(texts, ids, back))
    wrong = [i[:-1] for i in ids]
    assert [a for a, i in zip(tool.agreed(texts, wrong, back), ids) if len(i)] == [False] * sum(len(i) > 0 for i in ids)
    assert not any(tool.agreed(texts, ids, [b + "x" for b in back]))


@pytest.mark.parametrize("ids", [[], [1, 22557, 2], [200], [22557, 3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [13, 13]])
def test_decode_any_ids(theirs, ids):
    assert piece_codec.codec(MODEL).decode([ids]) == [theirs.decode(ids)]


def test_unigram_model():
    def field(n, kind, data):
        return bytes([n << 3 | kind]) + (bytes([len(data)]) + data if kind == 2 else data)

    import struct

    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("▁ab", -1.0, 1), ("b", -2.5, 1)]
    data = b"".join(
        field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces
    )
    data += field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(4, 0, b"\x00"))
    model = piece_codec.parse(data)
    assert (model.kind, model.byte_fallback, model.squeeze, model.pieces) == (1, False, False, pieces)
    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    tool = piece_codec.build(model)
    for text in ("ab", "ab a", "b a ab", "aab"):
        assert tool.encode(text).ids == other.encode(text)


def test_query(spark, folder, given, theirs):
    rows = queries.queries()["op3_piece_codec"](spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in given("documents").collect()}
    assert len(rows) == len(texts) and all(r["round_trip"] and r["same"] for r in rows)
    assert all(r["ids"] == theirs.encode(texts[r["doc_id"]]) for r in rows[:40])


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, 1, "x"), ("", 2, "y"), ("a b", 3, "z"), ("a b", 3, "z")], "text string, ids int, same string")
    rows = piece_codec.parity(df, MODEL).collect()
    assert [r["round_trip"] and r["same"] for r in rows] == [True] * 4 and sorted(len(r["ids"]) for r in rows) == [0, 0, 2, 2]
    assert piece_codec.parity(df.limit(0), MODEL).count() == 0
