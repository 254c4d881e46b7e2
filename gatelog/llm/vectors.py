"""Vectors as exact integers: from arrays of floats to packed whole numbers, and exact products of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a limb; the products of two limbs, added over up to 2**11 places, stay below 2**53.
LIMB_BITS = 21
#: Places whose products are added by one floating-point product; longer vectors are cut.
PLACES = 1 << 11


def integers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are whole, their lengths, and floor(scale · x) of all their components, one after another.

    A row is whole if it is not null and no component is null, NaN or infinite.
    """
    lists = column.cast(pa.list_(pa.float64()))
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    bad = np.flatnonzero(~np.isfinite(values.to_numpy(zero_copy_only=False)))  # a null is read as NaN
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ok = lists.is_valid().to_numpy(zero_copy_only=False).copy()
    ok[owner[bad]] = False
    scaled = np.floor(values.to_numpy(zero_copy_only=False)[ok[owner]] * scale)
    if len(scaled) and not np.abs(scaled).max() < 2.0**62:
        raise ValueError("a component is too large for 64-bit integers")
    return ok, lengths[ok], scaled.astype(np.int64)


def packed(matrix: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 1, 2, 4 or 8 bytes a component, so that equal rows have equal bytes."""
    if not matrix.shape[1]:
        return [b""] * len(matrix)
    low, high = matrix.min(axis=1), matrix.max(axis=1)
    out: list[bytes] = [b""] * len(matrix)
    width = np.full(len(matrix), 8)
    for size in (4, 2, 1):
        kind = np.iinfo(f"i{size}")
        width[(low >= kind.min) & (high <= kind.max)] = size
    for size in (1, 2, 4, 8):
        own = np.flatnonzero(width == size)
        data, step = matrix[own].astype(f"<i{size}").tobytes(), size * matrix.shape[1]
        for k, i in enumerate(own):
            out[i] = data[k * step : (k + 1) * step]
    return out


def unpacked(rows: list[bytes], places: int) -> np.ndarray:
    """The rows of ``packed`` as one matrix."""
    out = np.empty((len(rows), places), np.int64)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, f"<i{len(row) // places}") if places else 0
    return out


def whole_numbers(rows: DataFrame, vector: str, scale: int, **others: Column) -> DataFrame:
    """Per row with a whole vector: the other columns, ``places`` (its length) and ``v``, floor(scale · x) packed."""
    names = list(others)
    source = rows.select(*(c.alias(n) for n, c in others.items()), F.col(f"`{vector}`").alias("vector"))
    kinds = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, lengths, values = integers(batch.column(len(names)), scale)
            kept = batch.filter(pa.array(ok))
            data: list[bytes] = [b""] * len(lengths)
            begins = np.cumsum(lengths) - lengths
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                for i, row in zip(own, packed(values[begins[own][:, None] + np.arange(size)]), strict=True):
                    data[i] = row
            columns = [*kept.columns[: len(names)], pa.array(lengths, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "places", "v"])

    return source.mapInArrow(run, ", ".join(filter(None, [kinds, "places int, v binary"])))


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """The numbers as sums of limb · 2**(LIMB_BITS · i), limbs in float64; as many as the largest needs."""
    out = []
    while True:
        top = max(int(x.max()), -int(x.min()) - 1) if x.size else 0
        if top < 1 << LIMB_BITS:
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        x = x >> LIMB_BITS


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two int64 matrices, exact modulo 2**64.

    Each pair of limbs is one floating-point matrix product whose sums stay below 2**53; the products
    are put together in int64.
    """
    out = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], PLACES):
        left, right = limbs(a[:, at : at + PLACES]), limbs(b[:, at : at + PLACES])
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if LIMB_BITS * (i + j) < 64:
                    out += (x @ y.T).astype(np.int64) << (LIMB_BITS * (i + j))
    return out
