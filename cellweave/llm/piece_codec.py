"""Encoding and decoding with a SentencePiece model on the tokenizers library.

The model's protobuf is read here, and its normaliser, marker for spaces,
scores and byte fallback are rebuilt as a tokenizers pipeline, for models of the BPE
and of the unigram kind. Batches of whole texts go through the library's threads,
and ``parity`` compares every text's ids and decoding with the sentencepiece library's.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from cellweave.llm.shared import widened

MARK = "▁"
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Rows that a task encodes at once, and threads that share them.
BATCH, THREADS = 200, 2


@dataclass(frozen=True)
class PieceModel:
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    unk_id: int
    rules: bytes  # precompiled normalisation, empty if none
    dummy_prefix: bool
    squeeze: bool
    escape: bool


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


def parse(data: bytes) -> PieceModel:
    """Read a SentencePiece model file."""
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    return PieceModel(
        pieces,
        trainer.get(3, UNIGRAM),
        bool(trainer.get(35, 0)),
        unknown,
        normaliser.get(2, b""),
        bool(normaliser.get(3, 1)),
        bool(normaliser.get(4, 1)),
        bool(normaliser.get(5, 1)),
    )


def build(model: PieceModel):
    """The same codec as a pipeline of the tokenizers library."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    if model.kind == BPE:
        # A pair of pieces merges with the priority of the piece that it makes.
        ordered = sorted(
            ((-score, i, p) for i, (p, score, kind) in enumerate(model.pieces) if kind in (NORMAL, USER) and len(p) > 1)
        )
        usable = {p for p, _, kind in model.pieces if kind in (NORMAL, USER)}
        merges = [
            (p[:cut], p[cut:]) for _, _, p in ordered for cut in range(1, len(p)) if p[:cut] in usable and p[cut:] in usable
        ]
        core = models.BPE(
            vocab=vocabulary, merges=merges, unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback
        )
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"no model kind {model.kind}")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.rules)] if model.rules else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    tail = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return out


class Codec:
    """Encodes and decodes lists of texts with one model file; ``verify`` keeps the other library at hand."""

    def __init__(self, path: str, verify: bool = False):
        with open(path, "rb") as file:
            self.model = parse(file.read())
        self.tokenizer = build(self.model)
        # Merges never cross from another character to a mark unless some piece has one inside;
        # without such pieces a text is cut before its marks, which keeps merging short.
        inside = any(MARK in p.lstrip(MARK) for p, _, kind in self.model.pieces if kind in (NORMAL, USER))
        if self.model.kind == BPE and self.model.dummy_prefix and not inside:
            from tokenizers import Regex, pre_tokenizers

            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
        self.bytes = [_plain(p, kind) for p, _, kind in self.model.pieces]
        self.other = None
        if verify:
            import sentencepiece

            self.other = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; empty texts have none."""
        found = iter(self.tokenizer.encode_batch_fast([t for t in texts if t], add_special_tokens=False))
        return [np.array(next(found).ids if t else [], np.int32) for t in texts]

    def agreed(self, texts: list[str], ids: list[np.ndarray], back: list[str]) -> list[bool]:
        """Whether the sentencepiece library, ``self.other``, encodes each whole text to ``ids``, and decodes them to ``back``."""
        theirs = self.other.encode(texts, num_threads=THREADS)
        their_back = self.other.decode([i.tolist() for i in ids], num_threads=THREADS)
        return [a.tolist() == b and c == d for a, b, c, d in zip(ids, theirs, back, their_back)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of lists of ids.

        Pieces that join to valid UTF-8, as all that ``encode`` gives, are joined here;
        others go through the library's byte fallback, which marks what is no character.
        """
        plain = self.bytes
        out: list[str | None] = []
        for own in ids:
            joined = b"".join(map(plain.__getitem__, own))
            if self.model.dummy_prefix:
                first = next((i for i in own if self.model.pieces[i][2] != CONTROL), None)
                if first is not None and self.model.pieces[first][0].startswith(MARK):
                    joined = joined[1:]
            try:
                out.append(joined.decode())
            except UnicodeDecodeError:
                out.append(None)
        odd = [i for i, text in enumerate(out) if text is None]
        for i, text in zip(odd, self.tokenizer.decode_batch([list(ids[i]) for i in odd], skip_special_tokens=False)):
            out[i] = text
        return out


def _plain(piece: str, kind: int) -> bytes:
    if kind == BYTE:
        return bytes([int(piece[1:-1], 16)])
    if kind == UNKNOWN:
        return " ⁇ ".encode()
    return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()


@lru_cache(maxsize=2)
def codec(path: str, verify: bool = False) -> Codec:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    return Codec(path, verify)


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the piece ids of ``text``; NULL counts as empty and has no ids.

    ``model`` is a file that each executor can read. A column named ``ids`` is replaced.
    """
    kept = docs.drop("ids")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for part in _slices(batches):
            ids = tool.encode([t or "" for t in part.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids)], names=[*part.schema.names, "ids"])

    return kept.mapInArrow(run, widened(kept, ids=ArrayType(IntegerType())))


def decode(encoded: DataFrame, model: str, into: str = "decoded") -> DataFrame:
    """``encoded`` with the texts of ``ids`` in ``into``, which replaces a column of that name; NULL ids give ``""``."""
    kept = encoded.drop(into)
    at = kept.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for part in _slices(batches):
            texts = tool.decode([i or [] for i in part.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, into])

    return kept.mapInArrow(run, widened(kept, **{into: "string"}))


def round_trips(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, and ``round_trip``: the ids decode to the text. One pass, with one codec a task.

    Columns of these names are replaced; NULL counts as empty.
    """
    return _checked(docs, model, text, verify=False)


def parity(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``round_trips`` with ``same``: the sentencepiece library gives the whole text the same ids, and the ids the same text."""
    return _checked(docs, model, text, verify=True)


def _checked(docs: DataFrame, model: str, text: str, verify: bool) -> DataFrame:
    made = {"ids": ArrayType(IntegerType()), "round_trip": "boolean"} | ({"same": "boolean"} if verify else {})
    kept = docs.drop(*made)
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model, verify)
        for part in _slices(batches):
            texts = [t or "" for t in part.column(at).to_pylist()]
            ids = tool.encode(texts)
            back = tool.decode([i.tolist() for i in ids])
            columns = [*part.columns, _lists(ids), pa.array([a == b for a, b in zip(texts, back)], pa.bool_())]
            if verify:
                columns.append(pa.array(tool.agreed(texts, ids, back), pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *made])

    return kept.mapInArrow(run, widened(kept, **made))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of at most BATCH rows; the library's threads share the words of one part."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield batch.slice(start, BATCH)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
