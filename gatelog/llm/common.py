"""Helpers the operators share: inputs, shared scratch tables, digests, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatelog.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that every executor can reach."""
    return scratch_dir(spark, "llm")


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives executors.

    The shuffles behind the rows are of no use any more. Spark deletes their files when the driver
    collects garbage, which a driver with little to do puts off for long; so it is asked to.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a batch that goes to a Python worker (about). Spark's own bound lets in whole files, of which the
#: JVM and the worker hold several copies each, and idle workers keep the memory.
ARROW_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches are bounded by ``ARROW_BYTES``; a setting of the caller's holds."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, str(ARROW_BYTES))


def utf8(text: Column) -> Column:
    """The text's bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def digest(data: Column) -> Column:
    """A 16-byte name for a byte string: half of its SHA-256."""
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def whole(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no other column can clash with them."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns))


def only(docs: DataFrame, kept: DataFrame, **marks: Column) -> DataFrame:
    """The rows of ``docs`` whose marks occur in ``kept``, one row for each; nulls equal nulls.

    ``marks`` are columns of ``docs`` by the name they have in ``kept``.
    """
    marked = docs.select(whole(docs).alias("own"), *(c.alias(n) for n, c in marks.items()))
    wanted = kept.select(*(F.col(n).alias(f"kept_{n}") for n in marks))
    same = F.lit(True)
    for n in marks:
        same = same & F.col(n).eqNullSafe(F.col(f"kept_{n}"))
    return marked.join(wanted, same, "left_semi").dropDuplicates(list(marks)).select("own.*")


#: Bits of the map in ``likely`` (8 MB at most, whatever the input) and of one of its rows.
MAP_BITS, PAGE_BITS = 1 << 26, 32768


def likely(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in ``wanted`` (column ``key``) and a few others, without a shuffle of ``df``.

    The wanted keys' hashes set bits in a map of fixed size, which is broadcast. It spares large rows
    the shuffle of an exact join that follows; a full map only lets more rows through.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    page, place = F.floor(bit / PAGE_BITS), (bit % PAGE_BITS).cast("int")
    pages = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / PAGE_BITS).alias("map_page"))
    pages = pages.agg(F.bitmap_construct_agg(F.col("bit") % PAGE_BITS).alias("map_bits"))
    byte = F.conv(F.hex(F.substring("map_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte.cast("long"), place % 8) == 1
    joined = df.withColumn("map_page", page).join(F.broadcast(pages), "map_page")
    return joined.where(is_set).select(*df.columns)


def likely_marks(df: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """All rows, with a mark ``name`` on those that ``likely`` would keep."""
    bit = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    page, place = F.floor(bit / PAGE_BITS), (bit % PAGE_BITS).cast("int")
    pages = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / PAGE_BITS).alias("map_page"))
    pages = pages.agg(F.bitmap_construct_agg(F.col("bit") % PAGE_BITS).alias("map_bits"))
    byte = F.conv(F.hex(F.substring("map_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte.cast("long"), place % 8) == 1
    joined = df.withColumn("map_page", page).join(F.broadcast(pages), "map_page", "left")
    return joined.select(*df.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str, per_bucket: int = 20_000) -> DataFrame:
    """Adds ``name``: 0, 1, 2, … without gaps within ``keys``, in an arbitrary but fixed order.

    Rows go to hash buckets of about ``per_bucket`` rows, are numbered there, and are shifted by the
    sizes of the buckets before theirs, so no task ever holds all rows of a key. ``order`` must tell
    rows apart as far as their numbers matter; rows equal in it are interchangeable.
    """
    buckets = max(8, -(-df.count() // per_bucket))
    with_bucket = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = with_bucket.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = with_bucket.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(shifts, [*keys, "_bucket"])
    return joined.withColumn(name, F.col("_shift") + F.col("_rank")).drop("_bucket", "_rank", "_shift")
