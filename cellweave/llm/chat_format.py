"""Chat formatting on token level, with a loss mask.

Every segment of a conversation is encoded by itself, and turns are marked by
reserved ids that no text encodes to, so no content can forge a mark. Control
strings that occur in content are escaped as text too, so that the decoded form
stays unambiguous. Masks come from prefix sums over the segments' lengths.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template; reserved ids follow the tokenizer's own.
ROLES = ("system", "user", "assistant")
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|turn|>", "<|text|>", "<|end|>")
ESCAPE = "␛"  # the symbol for escape; doubled in content
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

SEGMENTS = (
    "conv_id long, turn long, role string, role_ids array<int>, text_ids array<int>"
)


def escape(text: str) -> str:
    """Content without any control string; ``unescape`` gives it back.

    The escape character is doubled, and set after the first character of each
    control string, which breaks the string up.
    """
    out = text.replace(ESCAPE, ESCAPE * 2)
    if any(c in out for c in CONTROL):
        # Longest first; what an insertion breaks cannot form a control string again.
        for control in sorted(CONTROL, key=len, reverse=True):
            out = out.replace(control, f"{control[0]}{ESCAPE}|{control[1:]}")
    return out


def unescape(text: str) -> str:
    if ESCAPE not in text:
        return text
    parts = text.split(ESCAPE * 2)
    return ESCAPE.join(p.replace(f"{ESCAPE}|", "") for p in parts)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def reserved(path: str) -> dict[str, int]:
    """Ids of the marks, after all ids of the tokenizer."""
    size = _tokenizer(path).get_vocab_size(with_added_tokens=True)
    return {mark: size + i for i, mark in enumerate((TURN, TEXT, END))}


def encode_segments(turns: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and the ids of the role's name and of the escaped text, per row.

    ``tokenizer`` is a byte-level tokenizer file that each executor can read.
    NULL texts and roles are empty; other columns are left out.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _tokenizer(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                roles = [r or "" for r in part["role"].to_pylist()]
                texts = [escape(t or "") for t in part["text"].to_pylist()]
                ids = [e.ids for e in model.encode_batch([escape(r) for r in roles] + texts, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["conv_id"],
                        part["turn"],
                        pa.array(roles, pa.string()),
                        pa.array(ids[: len(roles)], pa.list_(pa.int32())),
                        pa.array(ids[len(roles) :], pa.list_(pa.int32())),
                    ],
                    names=["conv_id", "turn", "role", "role_ids", "text_ids"],
                )

    picked = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    return picked.mapInArrow(encode, SEGMENTS)


def assemble(segments: DataFrame, tokenizer: str) -> DataFrame:
    """Per turn: ``ids`` with the marks spliced in, and ``loss``, a mask of the same length.

    A turn is <|turn|> role <|text|> text <|end|>. The mask covers the text of assistant turns.
    """
    marks = reserved(tokenizer)

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch["role"].to_pylist()
            head, body = batch["role_ids"], batch["text_ids"]
            head_n = np.diff(head.offsets.to_numpy())
            body_n = np.diff(body.offsets.to_numpy())
            lengths = head_n + body_n + 3
            ends = np.cumsum(lengths)
            starts = ends - lengths
            ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
            if len(ends):
                ids[starts], ids[starts + head_n + 1], ids[ends - 1] = marks[TURN], marks[TEXT], marks[END]
                ids[_spans(starts + 1, head_n)] = head.flatten().to_numpy()
                ids[_spans(starts + head_n + 2, body_n)] = body.flatten().to_numpy()
            # +1 where a masked text begins and -1 after it; the prefix sum is the mask.
            steps = np.zeros(len(ids) + 1, np.int8)
            masked = np.array([r == "assistant" for r in roles], bool) & (body_n > 0)
            np.add.at(steps, (starts + head_n + 2)[masked], 1)
            np.add.at(steps, (starts + head_n + 2 + body_n)[masked], -1)
            mask = np.cumsum(steps[:-1], dtype=np.int8)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"],
                    batch["turn"],
                    pa.ListArray.from_arrays(offsets, pa.array(ids)),
                    pa.ListArray.from_arrays(offsets, pa.array(mask)),
                ],
                names=["conv_id", "turn", "ids", "loss"],
            )

    return segments.mapInArrow(splice, "conv_id long, turn long, ids array<int>, loss array<tinyint>")


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions start, start + 1, ... of spans, one after another."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``loss_text`` and ``formatted_chars``, from ids and masks alone."""
    marks = reserved(tokenizer)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _tokenizer(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                roles, texts, losses = [], [], []
                for ids, mask in zip(part["ids"], part["loss"]):
                    ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                    middle = int(np.flatnonzero(ids == marks[TEXT])[0])
                    assert ids[0] == marks[TURN] and ids[-1] == marks[END]
                    roles.append(ids[1:middle].tolist())
                    texts.append(ids[middle + 1 : -1].tolist())
                    losses.append(ids[mask == 1].tolist())
                n = len(roles)
                raw = model.decode_batch(roles + texts + losses, skip_special_tokens=False)
                chars = [len(r) + len(t) + len(TURN + TEXT + END) for r, t in zip(raw[:n], raw[n : 2 * n])]
                plain = [unescape(t) for t in raw]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["conv_id"],
                        part["turn"],
                        pa.array(plain[:n], pa.string()),
                        pa.array(plain[n : 2 * n], pa.string()),
                        pa.array(plain[2 * n :], pa.string()),
                        pa.array(chars, pa.int64()),
                    ],
                    names=["conv_id", "turn", "role", "text", "loss_text", "formatted_chars"],
                )

    return formatted.mapInArrow(
        decode, "conv_id long, turn long, role string, text string, loss_text string, formatted_chars long"
    )


def digest(turns: DataFrame) -> DataFrame:
    """One row per conversation from the rows of ``read_back``, taken in order of ``turn``.

    A digest of a whole conversation needs its turns in order, so a conversation is
    folded in one task, but turn by turn: memory holds one batch of rows, however
    long the conversation. Turns with equal numbers are ordered by role, then text.
    A NULL ``conv_id`` is a conversation of its own.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for frame in frames:
            done = []
            ids = [None if pd.isna(i) else int(i) for i in frame["conv_id"]]
            rows = zip(ids, frame["role"], frame["text"], frame["loss_text"], frame["formatted_chars"])
            for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(_closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for _, role, text, loss, chars in group:
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                    state[5] += chars
            if done:
                yield pd.DataFrame(done, columns=_DIGEST).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([_closed(state)], columns=_DIGEST).astype({"conv_id": "Int64"})

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInPandas(fold, schema)


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _closed(state: list) -> tuple:
    conv, n, turns, loss_chars, loss, chars = state
    return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
