"""Product-quantisation codes of vectors, with codebooks that are exact on every machine.

Vectors are whole numbers cut into equal parts. Each part position has a codebook, improved by rounds
of nearest entry and mean. All distances are exact: inner products are put together from limbs whose
floating-point matrix products lose nothing, and the first of the least distances decides ties. Sums
are exact too, so the result does not depend on how the rows are dealt.

A round is one scan that puts out a partial sum per entry and task; the driver holds the codebooks
(entries times places numbers) and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import stored
from gatelog.llm.vectors import exact_products, unpacked, whole_numbers

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows compared with a codebook at a time.
BLOCK = 4096


def vectors(rows: DataFrame, vector: str, scale: int = SCALE, **others: Column) -> DataFrame:
    """The rows with whole vectors as integers: the other columns, ``places`` and ``v``; stored."""
    return stored(whole_numbers(rows, vector, scale, **others))


def places_of(whole: DataFrame, parts: int) -> int:
    """The length that all vectors share; 0 where there are none."""
    least, most = whole.agg(F.min("places"), F.max("places")).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} components")
    if (most or 0) % parts or most == 0:
        raise ValueError(f"{most} components do not make {parts} equal parts")
    return most or 0


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and part: the index of the nearest entry, least index first, and the squared distance.

    ``books`` is parts × entries × places of a part. Arithmetic is modulo 2**64, so every distance
    below 2**63 is right.
    """
    parts, _, step = books.shape
    codes = np.empty((len(x), parts), np.uint8)
    far = np.empty((len(x), parts), np.int64)
    for p in range(parts):
        own, book = np.ascontiguousarray(x[:, p * step : (p + 1) * step]), books[p]
        square = (own * own).sum(axis=1)
        distance = square[:, None] - 2 * exact_products(own, book) + (book * book).sum(axis=1)
        codes[:, p] = distance.argmin(axis=1)
        far[:, p] = distance[np.arange(len(x)), codes[:, p]]
    return codes, far


def blocks(batches: Iterator[pa.RecordBatch], places: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``BLOCK`` rows with their vectors, the last column."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = unpacked(part.column(part.num_columns - 1).to_pylist(), places)
            if x.size and 4 * int(np.abs(x).max()) ** 2 * places >= 1 << 63:
                raise ValueError("components are too large for 64-bit distances")
            yield part, x


def _sums(whole: DataFrame, books: np.ndarray, places: int) -> dict[tuple[int, int], list[int]]:
    """Per part and entry that is used: how many parts it is nearest to, and their sum."""
    parts, entries, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, step + 1), np.int64)
        for _, x in blocks(batches, places):
            codes, _ = nearest(x, books)
            for p in range(parts):
                own = np.concatenate([np.ones((len(x), 1), np.int64), x[:, p * step : (p + 1) * step]], axis=1)
                order = np.argsort(codes[:, p], kind="stable")
                entry, first = np.unique(codes[order, p], return_index=True)
                total[p * entries + entry.astype(np.int64)] += np.add.reduceat(own[order], first)
        used = np.flatnonzero(total[:, 0])
        slot, place = np.repeat(used, step + 1), np.tile(np.arange(step + 1), len(used))
        columns = [pa.array(slot, pa.int32()), pa.array(place, pa.int32()), pa.array(total[used].ravel(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "place", "total"])

    partial = whole.select("v").mapInArrow(run, "slot int, place int, total long")
    added = partial.groupBy("slot", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums: dict[tuple[int, int], list[int]] = {}
    for slot, place, total in added.collect():
        sums.setdefault((slot // entries, slot % entries), [0] * (step + 1))[place] = int(total)
    return sums


def codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts × entries × places of a part) after ``rounds``, from the rows with the least ``key``.

    Rows with equal keys are ordered by their vectors, null keys come last; fewer rows than entries give
    fewer entries.
    """
    places = places_of(whole, parts)
    first = whole.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()
    x = unpacked([bytes(r.v) for r in first], places)
    books = np.ascontiguousarray(x.reshape(len(x), parts, places // parts).transpose(1, 0, 2))
    for _ in range(rounds if len(x) else 0):
        for (p, entry), (count, *total) in _sums(whole, books, places).items():
            books[p, entry] = [t // count for t in total]
    return books


def encoded(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """Per row of ``vectors``: its other columns, ``code`` (binary, a byte per part) and ``error`` (squared, summed)."""
    parts, _, step = books.shape
    names = [n for n in whole.columns if n not in ("places", "v")]
    kinds = ", ".join(f"{n} {whole.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches, parts * step):
            codes, far = nearest(x, books)
            code = pa.array([row.tobytes() for row in codes], pa.binary())
            columns = [*batch.columns[: len(names)], code, pa.array(far.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "code", "error"])

    return whole.select(*names, "v").mapInArrow(run, f"{kinds}, code binary, error long")


def decoded(code: bytes, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, entry] for p, entry in enumerate(code)])


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row with a whole vector: vec_id, code (hex), error, label_error, codebooks_sha256.

    Rows whose vector is null or holds a null, NaN or infinite component are left out. ``label_error`` is
    the error summed over equal labels, nulls together: sums are combined before they are shuffled, and
    joined back. Repeated rows each count. No whole vectors give no rows. Vectors of different lengths, or
    of a length that does not divide by the parts, raise; so do components beyond 64-bit distances. Other
    columns are not read.
    """
    whole = vectors(rows, vector, key=F.col(key), label=F.col(label))
    if whole.isEmpty():
        empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return whole.sparkSession.createDataFrame([], empty)
    books = codebooks(whole)
    coded = stored(encoded(whole, books))
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = stored(sums).select(F.col("label").alias("own"), "label_error")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("own"))).select(
        F.col("key").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(fingerprint(books)).alias("codebooks_sha256"),
    )
