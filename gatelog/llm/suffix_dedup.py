"""Removal of long repeated substrings by bucket-pointer refinement over a sparse suffix array.

A full suffix array has an entry per byte; here only suffixes at anchors are entered. The anchor of a
window (every string of the given length) is the position of its least q-gram hash, so equal windows
have equal anchors, and about one byte in 85 is an anchor. Buckets have content-derived names, so a
bucket identifier at a later offset is known without looking up another suffix's row:

1. Initial buckets: the q-gram at the anchor. Suffixes alone in their bucket are done.
2. Refinement by the identifiers of all offsets that the windows of the anchor span, at once: members
   that agree there are repeated in all their windows.
3. Where a bucket still holds different members, one of each kind is cut into blocks of a few windows.
   Blocks whose common core occurs once have no repeated window; blocks that agree in all they cover
   are repeated; the others go on.
4. The windows of the remaining blocks are refined one by one. An identifier is the difference of two
   prefix sums, so that all levels of the recursion reuse the same sums of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import digest, stored, utf8
from gatelog.llm.shingles import mixed

#: Bytes of the initial q-gram, unless the windows ask for more or less (see ``gram_bytes``).
GRAM = 32
#: Texts are worked on in pieces of at most this many windows (positions must fit ``_PLACE`` bits).
PIECE, _PLACE = 1 << 18, np.uint64(20)
#: Windows of a block.
BLOCK = 16
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _tables(size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per family: a random number per byte value, powers of the base, and of its inverse modulo 2**64."""
    out, random = [], np.random.default_rng(11)
    for base in _BASES:
        values = random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        steps = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 2**64))]
        for step in steps:
            step[0] = 1
        powers, inverses = (np.cumprod(step, dtype=np.uint64) for step in steps)
        out.append((values, powers, inverses))
    return out


def gram_bytes(length: int) -> int:
    """q for windows of this length: a run then has at most 255 windows, which fits its packed form."""
    return max(min(GRAM, length), length - 254)


class Names:
    """Bucket identifiers of all substrings of a buffer, from prefix sums."""

    def __init__(self, buffer: np.ndarray, family: int) -> None:
        values, powers, self.inverses = _tables(3 << 18)[family]
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(values[buffer] * powers[: len(buffer)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from the least of powers of two."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Buffers of texts end to end, with (text number, offset in the text, bytes) for each part.

    A text longer than a piece is cut with an overlap that puts each window into one part exactly.
    """
    parts: list[tuple[int, int, int]] = []
    data: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[at : at + PIECE + length - 1]
            parts.append((i, at, len(part)))
            data.append(part)
            size += len(part)
            if size >= PIECE:
                yield b"".join(data), parts
                parts, data, size = [], [], 0
    if parts:
        yield b"".join(data), parts


def runs(data: bytes, parts: list[tuple[int, int, int]], length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor.

    q-gram bucket, refined bucket, part number, first window in the text, windows, and how far the
    anchor is behind the first window.
    """
    buffer = np.frombuffer(data, np.uint8)
    first, second, gram = Names(buffer, 0), Names(buffer, 1), gram_bytes(length)
    places = np.arange(len(buffer) - gram + 1)
    grams = first.of(places, places + gram)
    keyed = grams >> _PLACE << _PLACE | places.astype(np.uint64)
    anchors = (_least(keyed, length - gram + 1) & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
    sizes = np.array([p[2] for p in parts])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    shift = np.repeat(begins - (np.cumsum(counts) - counts), counts)
    windows = np.arange(counts.sum()) + shift
    anchor = anchors[windows]
    change = np.flatnonzero(np.diff(anchor, prepend=-1) != 0)
    starts = windows[change]
    widths = np.diff(np.append(change, len(windows)))
    part = np.searchsorted(begins, starts, "right") - 1
    refined = second.of(starts, starts + widths + length - 1)
    offsets = np.array([p[1] for p in parts])
    return grams[anchor[change]], refined, part, starts - begins[part] + offsets[part], widths, anchor[change] - starts


def _suffixes(texts: DataFrame, length: int) -> DataFrame:
    """Per run of windows: gram, refined, key, place (first window, anchor's distance and windows, in one number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            keys = batch.column(0)
            for data, parts in pieces(bodies, length):
                gram, refined, part, start, width, distance = runs(data, parts, length)
                owner = np.array([p[0] for p in parts])[part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)),
                        pa.array(refined.view(np.int64)),
                        keys.take(pa.array(owner)),
                        pa.array(start << 16 | distance << 8 | width),
                    ],
                    ["gram", "refined", "key", "place"],
                )

    return texts.mapInArrow(run, "gram long, refined long, key binary, place long")


def _by_piece(body: bytes, starts: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, Names, Names]]:
    """Which of the sorted starts lie in each piece of a text, with the identifiers of the piece."""
    for at in range(0, len(body), PIECE):
        own = np.arange(np.searchsorted(starts, at), np.searchsorted(starts, at + PIECE))
        if len(own):
            buffer = np.frombuffer(body[at : at + PIECE + length + 256], np.uint8)
            yield at, own, Names(buffer, 0), Names(buffer, 1)


def block_windows(length: int) -> int:
    return max(1, min(BLOCK, length // 2))


def _blocks(texts: DataFrame, length: int) -> DataFrame:
    """Per block of the listed runs: core, cover, key, place (first window · 256 + windows). Columns in: key, body, places.

    A block holds the windows whose distance to the anchor has the same quotient by the block's size;
    its core is what every such window covers, whichever of them the text has.
    """
    size = block_windows(length)

    def cut(body: bytes, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        start, far, width = places >> 16, places >> 8 & 255, places & 255
        first, last = (far - width + 1) // size, far // size
        n = last - first + 1
        run = np.repeat(np.arange(len(places)), n)
        block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[run]
        near = np.maximum(block * size, (far - width + 1)[run])
        away = np.minimum(block * size + size - 1, far[run])
        anchor = (start + far)[run]
        for at, own, one, two in _by_piece(body, start[run], length):
            begin, end = anchor[own] - away[own] - at, anchor[own] - near[own] - at + length
            core = anchor[own] - block[own] * size - at
            covers = two.of(begin, end)
            cores = one.of(core, core - size + 1 + length)
            yield cores, covers, begin + at << 8 | away[own] - near[own] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                places = np.sort(batch.column(2)[i].values.to_numpy())
                for cores, covers, place in cut(batch.column(1)[i].as_py(), places):
                    key = pa.array([batch.column(0)[i].as_py()] * len(place), pa.binary())
                    columns = [pa.array(cores.view(np.int64)), pa.array(covers.view(np.int64)), key, pa.array(place)]
                    yield pa.RecordBatch.from_arrays(columns, ["core", "cover", "key", "place"])

    return texts.mapInArrow(run, "core long, cover long, key binary, place long")


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """Per window of the listed blocks: its 128-bit bucket (high, low), key and start. Columns in: key, body, places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                places = np.sort(batch.column(2)[i].values.to_numpy())
                start, width = places >> 8, places & 255
                starts = np.repeat(start - np.cumsum(width) + width, width) + np.arange(width.sum())
                for at, own, one, two in _by_piece(batch.column(1)[i].as_py(), starts, length):
                    begin = starts[own] - at
                    high, low = (names.of(begin, begin + length).view(np.int64) for names in (one, two))
                    key = pa.array([batch.column(0)[i].as_py()] * len(own), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), key, pa.array(starts[own])], ["high", "low", "key", "start"])

    return texts.mapInArrow(run, "high long, low long, key binary, start long")


def _assembled(texts: DataFrame, length: int) -> DataFrame:
    """Per text: key, n_removed, n_spans, kept_sha256, spans. Columns in: key, body, places (of repeated windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, shas, where = [], [], [], []
            for i in range(batch.num_rows):
                body, packed = batch.column(1)[i].as_py(), batch.column(2)[i].values.to_numpy()
                change = np.zeros(len(body) + 1, np.int32)
                np.add.at(change, packed >> 8, 1)
                np.add.at(change, (packed >> 8) + (packed & 255) + length - 1, -1)
                covered = np.cumsum(change) > 0
                edge = np.diff(covered.view(np.int8), prepend=0)
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                kept = b"".join(body[a:b] for a, b in zip([0, *end], [*begin, len(body)], strict=True))
                removed.append(int((end - begin).sum()))
                spans.append(len(begin))
                shas.append(hashlib.sha256(kept).hexdigest())
                where.append([{"start": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string()), pa.array(where, kind)],
                ["key", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return texts.mapInArrow(
        run, "key binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    )


def _refined(members: DataFrame, bucket: str, finer: str) -> tuple[DataFrame, DataFrame]:
    """Members that another one equals in the finer bucket too; and one member of each finer bucket,
    where a bucket holds several of them: (key, place) both. Hot buckets are combined before the shuffle."""
    kinds = stored(
        members.groupBy(bucket, finer).agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one"))
    )
    equal = members.join(kinds.where("n > 1").select(bucket, finer), [bucket, finer], "left_semi").select("key", "place")
    several = stored(kinds.groupBy(bucket).agg(F.count("*").alias("k")).where("k > 1").select(bucket))
    return equal, kinds.join(several, bucket, "left_semi").select("one.key", "one.place")


def _listed(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Texts with their places, as many as a text has."""
    own = places.groupBy("key").agg(F.collect_list("place").alias("places"))
    return texts.join(own, "key").select("key", "body", "places")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of start, end in bytes).

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in the
    same text or another; strings are judged on the input. Null texts are empty; texts shorter than
    ``length`` lose nothing. Of repeated rows and copies each loses all bytes, as each starts elsewhere
    too. An empty table gives no rows. Only ``key`` and ``text`` are read. Bucket identifiers have 128
    bits, which stand for the strings.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        digest(utf8(F.col(text))).alias("key"),
        F.octet_length(utf8(F.col(text))).cast("long").alias("n_bytes"),
        F.sha2(utf8(F.col(text)), 256).alias("whole"),
    )
    source = docs.select(digest(utf8(F.col(text))).alias("key"), utf8(F.col(text)).alias("body"))
    suffixes = _suffixes(source, length)
    # lists of keys are stored before they are joined: a join of two plain shuffles is one that the engine can split at hot keys
    grams = stored(suffixes.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    shared = stored(suffixes.join(grams, "gram", "left_semi"))
    affected = shared.select("key").distinct()
    texts = stored(source.join(affected, "key", "left_semi").dropDuplicates(["key"]))

    settled, runs_left = _refined(shared, "gram", "refined")
    settled = stored(settled.select("key", (F.shiftright("place", 16) * 256 + F.col("place").bitwiseAND(F.lit(255))).alias("place")).distinct())
    blocks = stored(_blocks(_listed(texts, runs_left), length))
    cores = stored(blocks.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"))
    sure, blocks_left = _refined(stored(blocks.join(cores, "core", "left_semi")), "core", "cover")
    windows = stored(_windows(_listed(texts, blocks_left), length))
    twice = stored(windows.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").select("high", "low"))
    single = windows.join(twice, ["high", "low"], "left_semi").select("key", (F.col("start") * 256 + 1).alias("place"))

    result = stored(_assembled(_listed(texts, settled.union(sure).union(single)), length))
    return rows.join(result, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
    )
