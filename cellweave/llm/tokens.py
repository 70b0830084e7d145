"""Hashes of white-space tokens for many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Bytes of text that are worked on together.
CHUNK = 2 << 20
# Bytes that are hashed together, at 8 bytes an array for each; a longer text is cut at white space.
PIECE = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(20_240_917).integers(1, 2**63, 256).astype(np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * PIECE + 1024)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def token_hashes(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every token of ``buffer``, with A-Z in lower case."""
    data = np.frombuffer(buffer, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = powers(len(data) + 1)
    blank = SPACE[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    values = _VALUE[LOWER[data]]
    values *= up[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut at white space into parts of about PIECE bytes."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut < len(text) and not SPACE[text[cut]]:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def chunks(texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in order, many at a time: the first one's number, all their token hashes, and where each text's begin.

    The last array has one entry more than there are texts. NULL counts as empty.
    """
    first, parts, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if parts and size + len(raw) > CHUNK:
            yield first, *_together(parts)
            first, parts, size = i, [], 0
        parts.append(raw)
        size += len(raw) + 1
    if parts:
        yield first, *_together(parts)


def _together(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes, bounds, n = [], [np.zeros(1, np.int64)], 0
    for held in _held(parts):
        if len(held) == 1 and len(held[0]) > PIECE:
            found = [token_hashes(p)[0] for p in _pieces(held[0])]
            ends = np.array([sum(len(h) for h in found)])
        else:
            own, starts = token_hashes(b"\n".join(held))
            found, ends = [own], np.searchsorted(starts, np.cumsum([len(p) + 1 for p in held]))
        hashes += found
        bounds.append(ends + n)
        n += int(ends[-1])
    return np.concatenate(hashes), np.concatenate(bounds)


def _held(parts: list[bytes]) -> Iterator[list[bytes]]:
    """``parts`` in order, of about PIECE bytes together; a longer one is alone."""
    held, size = [], 0
    for part in parts:
        if held and size + len(part) > PIECE:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part) + 1
    yield held
