"""Exact deduplication by composable polynomial fingerprints.

A text without white space is read as a number in base 256 modulo a large prime. The fingerprint of a
concatenation follows from those of its parts, f(ab) = f(a) · 256^|b| + f(b), so slices of a huge
document are fingerprinted by different tasks and combined. Texts whose fingerprints agree are then
compared chunk by chunk; a group that turns out to hold different texts is split by SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import only, small_batches, stored

#: A prime of 120 bits far from any power of two, so that 256 has no short relations modulo it.
PRIME = 0xC90FDAA22168C234C4C6628B80DC83
#: Deleted before comparison: space and the five ASCII controls from tab to carriage return.
IGNORED = b" \t\n\x0b\x0c\r"
#: Bytes hashed at a time; bytes from which a document is cut into slices for other tasks.
CHUNK, SLICE = 1 << 16, 1 << 22
#: Bits of the map of repeated fingerprints (8 MB, whatever the input): spares most unique texts the shuffle.
MAP_BITS = 1 << 26
#: Bits of one row of that map, as Spark's bitmap functions have it.
PAGE = 32768


def combine(left: int, right: int, right_bytes: int, prime: int = PRIME) -> int:
    """The fingerprint of two byte strings put together."""
    return (left * pow(256, right_bytes, prime) + right) % prime


def fingerprint(data: bytes, prime: int = PRIME) -> int:
    """Chunk by chunk; any way of cutting gives the same number."""
    value = 0
    for at in range(0, len(data), CHUNK):
        chunk = data[at : at + CHUNK]
        value = combine(value, int.from_bytes(chunk, "big") % prime, len(chunk), prime)
    return value


def _packed(value: int) -> bytes:
    return value.to_bytes(16, "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE, prime: int = PRIME) -> DataFrame:
    """Per row: row (a number for the row), doc_id, n_chars, n_bytes, sha, fp; stored in the shared folder.

    Null texts count as empty.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_chars", "n_bytes", "sha", "slice", "data", "fp"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), None, pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for row, doc_id, value in zip(*batch.columns, strict=True):
                whole = value.as_py() or ""
                plain = whole.encode().translate(None, IGNORED)
                common = (row.as_py(), doc_id.as_py(), len(whole), len(plain), hashlib.sha256(plain).hexdigest())
                if len(plain) <= slice_bytes:
                    parts = [(0, None, _packed(fingerprint(plain, prime)))]
                else:
                    parts = [(i, plain[at : at + slice_bytes], None) for i, at in enumerate(range(0, len(plain), slice_bytes))]
                for part in parts:
                    for column, item in zip(columns, (*common, *part), strict=True):
                        column.append(item)
            types[1] = batch.schema.field(1).type
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(6)
            fps = [_packed(fingerprint(d.as_py(), prime)) for d in data]
            sizes = [len(d.as_py()) for d in data]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(sizes, pa.int64()), pa.array(fps, pa.binary())],
                ["row", "doc_id", "n_chars", "n_bytes", "sha", "slice", "size", "fp"],
            )

    lean = f"row long, doc_id {kind}, n_chars long, n_bytes long, sha string"
    cuts = stored(source.mapInArrow(cut, f"{lean}, slice int, data binary, fp binary"))
    columns = ["row", "doc_id", "n_chars", "n_bytes", "sha"]
    small = cuts.where("fp is not null").select(*columns, "fp")
    slices = cuts.where("fp is null").repartition("row", "slice")
    parts = slices.mapInArrow(hashed, f"{lean}, slice int, size long, fp binary")

    @F.arrow_udf("binary")
    def fold(lists: pa.Array) -> pa.Array:
        out = []
        for pieces in lists:
            value = 0
            for piece in sorted(pieces.as_py(), key=lambda p: p["slice"]):
                value = combine(value, int.from_bytes(piece["fp"], "big"), piece["size"], prime)
            out.append(_packed(value))
        return pa.array(out, pa.binary())

    large = parts.groupBy(*columns).agg(F.collect_list(F.struct("slice", "size", "fp")).alias("parts"))
    return stored(small.unionByName(large.select(*columns, fold("parts").alias("fp"))))


def _bit(fp: Column) -> Column:
    """A packed fingerprint's bit of the map: its value modulo ``MAP_BITS``."""
    return F.conv(F.hex(F.substring(fp, 13, 4)), 16, 10).cast("long") % MAP_BITS


def differing(docs: DataFrame, rows: DataFrame, text: str = "text", prime: int = PRIME) -> DataFrame:
    """Fingerprints (fp, n_bytes) whose texts are not all equal, found by comparing chunk with chunk.

    For each chunk number the least and the greatest chunk of a group are kept; they are combined before
    the shuffle, so a group with a third of all rows costs each task one row per chunk. One Python step
    looks fingerprints up and cuts, so a task has one worker and texts that occur once never leave it.
    """
    repeated = rows.groupBy("fp", "n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("fp", "n_bytes")
    bits = repeated.select(_bit(F.col("fp")).alias("bit"))
    maps = (
        bits.groupBy(F.floor(F.col("bit") / PAGE).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("bit") % PAGE).alias("map"))
        .collect()
    )  # at most MAP_BITS bits in all
    known = docs.sparkSession.sparkContext.broadcast({r["bucket"]: bytes(r["map"]) for r in maps})

    def packed(columns: list[list]) -> pa.RecordBatch:
        types = (pa.binary(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["fp", "n_bytes", "chunk", "data"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            held = 0
            for value in batch.column(0):
                data = (value.as_py() or "").encode().translate(None, IGNORED)
                fp = fingerprint(data, prime)
                at = fp % MAP_BITS
                page = known.value.get(at // PAGE)
                if page is None or not page[at % PAGE >> 3] >> (at & 7) & 1:
                    continue
                for i, start in enumerate(range(0, len(data), CHUNK)):
                    for column, item in zip(columns, (_packed(fp), len(data), i, data[start : start + CHUNK]), strict=True):
                        column.append(item)
                held += len(data)
                if held >= SLICE:
                    yield packed(columns)
                    columns, held = [[], [], [], []], 0
            yield packed(columns)

    cuts = docs.select(F.col(text).alias("text")).mapInArrow(chunks, "fp binary, n_bytes long, chunk int, data binary")
    ends = cuts.groupBy("fp", "n_bytes", "chunk").agg(F.min("data").alias("least"), F.max("data").alias("greatest"))
    return ends.where("least <> greatest").select("fp", "n_bytes").distinct()


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", prime: int = PRIME, slice_bytes: int = SLICE) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same without ASCII white space; null counts as empty, so null, empty
    and blank texts form one group. Of a group the row with the most code points stays, then that with
    the smallest ``key`` (null last); of rows alike in both, one stays. An empty table gives no rows.
    Only ``key`` and ``text`` are read, so other columns can have any name.
    """
    small_batches(docs.sparkSession)
    rows = fingerprints(docs, key, text, slice_bytes, prime)
    mixed = stored(differing(docs, rows, text, prime)).withColumn("mixed", F.lit(True))
    told = rows.join(mixed, ["fp", "n_bytes"], "left").withColumn("part", F.when(F.col("mixed"), F.col("sha")).otherwise(""))
    own = ["fp", "n_bytes", "part"]
    best = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row").alias("d")))
    # stored, so that the join below is one that the engine can split at a hot group
    keepers = stored(told.groupBy(*own).agg(F.count("*").alias("group_size"), best.alias("best")))
    return told.join(keepers, own).select(
        "doc_id",
        F.col("best.c").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.d")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_chars",
    )


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; one row per distinct text.

    Rows alike in ``key`` and text are one row as far as ``key`` and text go: one of them stays.
    """
    kept = groups(docs, key, text).where("kept")
    blank = F.coalesce(F.col(text), F.lit(""))
    plain = F.sha2(F.translate(blank, IGNORED.decode(), "").cast("binary"), 256)
    return only(docs, kept, doc_id=F.col(key), text_sha256=plain, n_chars=F.length(blank).cast("long"))
