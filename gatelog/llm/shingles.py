"""Word shingles of texts as 64-bit numbers, for many texts at once."""

from __future__ import annotations

import re

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (splitmix64)."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes turned into words at a time; longer texts are cut at white space.
CUT = 1 << 20
_CUT_AT = re.compile(rb"[ \t-\r]")


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of each text, A-Z lower-cased, and where each text's words begin.

    Words are runs of bytes other than space and tab to carriage return.
    """
    parts: list[bytes] = []
    first = [0]
    for text in texts:
        at = 0
        while len(text) - at > CUT and (cut := _CUT_AT.search(text, at + CUT)):
            parts.append(text[at : cut.start()])
            at = cut.start()
        parts.append(text[at:] if at else text)
        first.append(len(parts))
    out, counts, start, size = [], [np.zeros(1, np.int64)], 0, 0
    for i, part in enumerate(parts):
        size += len(part)
        if size >= CUT or i == len(parts) - 1:
            hashes, own = _words(parts[start : i + 1])
            out.append(hashes)
            counts.append(own)
            start, size = i + 1, 0
    begins = np.cumsum(np.concatenate(counts))
    return np.concatenate(out) if out else np.empty(0, np.uint64), begins[first]


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    inside = ~_SPACE[buffer]
    edge = np.diff(inside.view(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = np.flatnonzero(edge == -1) - starts  # every text is followed by a space
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(lengths.max(), _BASE), dtype=np.uint64)
    hashes = np.add.reduceat(_BYTES[buffer[inside]] * powers[place], first)
    return mixed(hashes + lengths.astype(np.uint64)), np.diff(np.searchsorted(starts, ends), prepend=0)


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each text, repeats included, and where each text's begin.

    A text with fewer than ``size`` words has its whole sequence as one; one without words has none.
    """
    hashes, begins = words(texts)
    counts = np.diff(begins)
    sums = hashes.copy()
    for k in range(1, min(size, len(sums))):  # sums[i] covers up to ``size`` words from i
        sums[: len(sums) - k] = sums[: len(sums) - k] * np.uint64(0xD6E8FEB86659FD93) + hashes[k:]
    out_counts = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_begins = np.concatenate([[0], np.cumsum(out_counts)])
    take = np.arange(out_begins[-1]) + np.repeat(begins[:-1] - out_begins[:-1], out_counts)
    result = sums[take] if len(take) else np.empty(0, np.uint64)
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.full(1, counts[i], np.uint64)
        for h in hashes[begins[i] : begins[i + 1]]:
            value = mixed(value) + h
        result[out_begins[i]] = value[0]
    return mixed(result, size), out_begins


def distinct(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Each text's set of shingles, sorted."""
    values, begins = shingles(texts, size)
    return [np.unique(values[begins[i] : begins[i + 1]]) for i in range(len(texts))]


def sketches(values: np.ndarray, begins: np.ndarray, coordinates: int, short: int) -> tuple[np.ndarray, np.ndarray]:
    """Minwise hashes: for each coordinate the least of a text's shingles in an order of its own.

    One row per text with shingles, in the order of the texts: ``coordinates`` whole hashes, and the
    last byte of ``short`` others, enough to estimate a similarity.
    """
    starts = begins[:-1][np.diff(begins) > 0]
    out = np.empty((len(starts), coordinates), np.uint32)
    fine = np.empty((len(starts), short), np.uint8)
    low, high = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    seeds = np.random.default_rng(7).integers(1, 2**32, (coordinates + short, 2), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    for c in range(coordinates + short):
        x = low * seeds[c, 0] + high * seeds[c, 1]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        least = np.minimum.reduceat(x, starts) if len(starts) else 0
        if c < coordinates:
            out[:, c] = least
        else:
            fine[:, c - coordinates] = least & 255
    return out, fine
