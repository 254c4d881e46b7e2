"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

A pre-token is a linked list of byte positions. Every adjacent pair that has a merge rank is put into
the bucket of that rank; a bitmap of two levels (which buckets have entries, which words of that have
bits) finds the smallest rank with two find-first-set steps. A popped entry whose pair
has changed since is stale and is skipped. Each merge costs a constant number of bitmap steps, so a
pre-token of n bytes takes O(n) pops, however long it is; a bucket's heap keeps equal ranks leftmost first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import small_batches

#: Encoded pre-tokens a worker remembers, and the longest it remembers (bounds its memory).
CACHE_ENTRIES, CACHE_LENGTH = 400_000, 64


#: Bits in a bitmap word; Python's integers make wide words as cheap as narrow ones.
_BITS = 256
_SINGLE = [1 << i for i in range(_BITS)]


def encode_piece(piece: bytes, ranks: dict[bytes, int], words: list[int]) -> list[int]:
    """Token ids of one pre-token: lowest rank first, leftmost of equals.

    ``words`` is the lower level of the bitmap, a bit for each rank whose bucket has entries; all zero
    before and after. ``top`` is its upper level, a bit for each word that is not zero.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, rank_of, single = len(piece), ranks.get, _SINGLE
    parts: list = [piece[i : i + 1] for i in range(n)]
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    waiting: list = [rank_of(piece[i : i + 2]) for i in range(n - 1)]
    waiting.append(None)
    buckets: dict[int, list[int]] = {}
    top = 0
    for i, rank in enumerate(waiting):
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(i)  # ascending, so a heap
            else:
                buckets[rank] = [i]
                words[rank >> 8] |= single[rank & 255]
                top |= 1 << (rank >> 8)
    while top:
        block = (top & -top).bit_length() - 1
        word = words[block]
        lowest = word & -word
        rank = block << 8 | lowest.bit_length() - 1
        bucket = buckets[rank]
        i = bucket[0] if len(bucket) == 1 else heappop(bucket)
        if waiting[i] == rank:  # else stale: one of the two was merged meanwhile
            j = after[i]
            parts[i] += parts[j]
            parts[j] = waiting[j] = None
            j = after[i] = after[j]
            if j >= 0:
                before[j] = i
            k = before[i]
            for left, right in ((i, j), (k, i)):
                if left >= 0 and right >= 0:
                    offered = waiting[left] = rank_of(parts[left] + parts[right])
                    if offered is not None:
                        if offered in buckets:
                            heappush(buckets[offered], left)
                        else:
                            buckets[offered] = [left]
                            words[offered >> 8] |= single[offered & 255]
                            top |= 1 << (offered >> 8)
                elif left >= 0:
                    waiting[left] = None
            bucket = buckets[rank]
        if len(bucket) == 1 and bucket[0] == i:
            del buckets[rank]
            words[block] &= ~lowest
            if not words[block]:
                top &= ~(1 << block)
    return [ranks[p] for p in parts if p is not None]


class Encoder(dict):
    """Pre-token → packed ids; remembers short pre-tokens in two generations of bounded size."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = [0] * ((max(self.ranks.values()) >> 8) + 1)
        self.find = regex.compile(pattern).findall
        self.table = {i: token for token, i in self.ranks.items()}
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            # a lone surrogate cannot come from a Spark string
            packed = np.array(encode_piece(piece.encode(), self.ranks, self.words), dtype="<u4").tobytes()
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def packed(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.find(text)))

    def decoded(self, packed: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process. ``path`` is a file installed on every machine."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Adds ``ids`` (array of int) to all columns; a null text gives an empty array.

    A column already called ``ids`` is replaced. Rows are independent: repeated rows stay repeated, an
    empty table stays empty, other columns pass through unread.
    """
    return docs.withColumn(ids, _ids(path, pattern)(F.col(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Adds ``text`` (binary): the bytes the ids stand for; null ids give empty bytes."""
    return docs.withColumn(text, _bytes(path, pattern)(F.col(ids)))


def _ids(path: str, pattern: str):
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        packed = [own.packed(t.as_py() or "") for t in texts]
        offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
        values = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    return run


def _bytes(path: str, pattern: str):
    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return pa.array([own.decoded(np.array(x.as_py() or [], "<u4").tobytes()) for x in lists], pa.binary())

    return run


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, n_tokens, ids_sha256, decoded_sha256. Encodes, then decodes the ids.

    The ids of one text at a time are held, never those of a batch. A null text counts as empty.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            counts, ids, back = [], [], []
            for value in batch.column(1):
                packed = own.packed(value.as_py() or "")
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(own.decoded(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
