"""Tables in daily folders whose small files are merged while they are read, and versioned tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size that parts are merged up to.
TARGET_BYTES = 128 << 20


class Files:
    """Names in the folders of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession):
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._paths(path)
        return where.getFileSystem(self._conf), where

    def names(self, folder: str) -> list[str]:
        files, where = self._at(folder)
        return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []

    def mark(self, path: str, again: bool = False, text: str = "") -> None:
        """A file of a line at most; with ``again`` it may be there already."""
        files, where = self._at(path)
        if not (again and files.exists(where)):
            stream = files.create(where, False)
            stream.write(bytearray(text, "utf-8"))
            stream.close()

    def folder(self, path: str) -> None:
        files, where = self._at(path)
        files.mkdirs(where)

    def delete(self, path: str) -> None:
        files, where = self._at(path)
        files.delete(where, True)

    def size(self, folder: str) -> int:
        files, where = self._at(folder)
        return files.getContentSummary(where).getLength()


#: Characters that name a run: its lane, a letter, and its number; more may follow.
RUN = 13


def first_last(part: str) -> tuple[str, str]:
    """The first and the last of the parts that a merged part holds; a plain part is both."""
    first, _, last = part.partition("~")
    return first, last or first


class DayTable:
    """A table below one folder: ``<day>=<value>/part=<run>/``, and more partitions below if named.

    A run writes a part of its own to each day it has rows of, so a repeated run finds its part
    again. Names are a letter, the lane, and a number, by which runs of a lane follow each other.

    Small parts of a day that follow each other are merged into one, named ``<first>~<last>``. What is
    to be read is told by empty files in a folder beside the table: ``pending`` hides a merged part while
    it is written, ``done`` makes it take the place of the parts between its first and last, at once for
    all readers. Those stay until the next merge, so that readers that have listed them can go on; then
    they and the two files go. The newest run of a lane may be written still, or again, and is in no merge.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType, day: str, inner: tuple[str, ...] = ()):
        self.spark, self.day, self.inner = spark, day, inner
        self.schema, self.files = schema, Files(spark)
        self.path, self.swaps = f"{root}/{name}", f"{root}/swaps/{name}"
        self._with_part = T.StructType([*schema.fields, T.StructField("part", T.StringType())])

    def create(self) -> None:
        for folder in (self.path, self.swaps):
            self.files.delete(folder)
        self.files.folder(self.path)

    def _writer(self, rows: DataFrame, **options):
        return rows.write.options(**options).partitionBy(self.day, "part", *self.inner)

    def replace(self, rows: DataFrame, run: str, **options) -> None:
        """This run's rows, in place of those that an earlier attempt left in the same days."""
        dynamic = {"partitionOverwriteMode": "dynamic", **options}
        self._writer(rows.withColumn("part", F.lit(run)), **dynamic).mode("overwrite").parquet(self.path)

    def append(self, rows: DataFrame, run: str, **options) -> None:
        """Rows beside those that an earlier attempt of the run left."""
        self._writer(rows.withColumn("part", F.lit(run)), **options).mode("append").parquet(self.path)

    def remove(self, run: str) -> None:
        """Drop the newest day's part of a run: a repeated run may fall on a later day."""
        for day in self.days()[:1]:
            if f"part={run}" in self.files.names(f"{self.path}/{day}"):
                self.files.delete(f"{self.path}/{day}/part={run}")

    def days(self) -> list[str]:
        """Folder names, newest first."""
        prefix = f"{self.day}="
        return sorted((n for n in self.files.names(self.path) if n.startswith(prefix)), reverse=True)

    def _marks(self) -> tuple[set[tuple[str, str]], set[tuple[str, str]]]:
        """(day, merged part) of merges that are being written, and of those that count."""
        marks = [tuple(n.split("@")) for n in self.files.names(self.swaps)]
        done = {m[1:] for m in marks if m[0] == "done"}
        return {m[1:] for m in marks if m[0] == "pending"} - done, done

    def _visible(self) -> Column | None:
        """A filter on partition columns that leaves out what a merge replaces or has not finished."""
        pending, done = self._marks()
        day, part = F.col(self.day).cast("string"), F.col("part")
        hidden = [(day == d) & (part == p) for d, p in sorted(pending)]
        for d, merged in sorted(done):
            first, last = first_last(merged)
            hidden.append((day == d) & part.between(first, last) & (part != merged))
        return ~_any(hidden) if hidden else None

    def _of(self, paths: list[str], parts: bool = False) -> DataFrame:
        reader = self.spark.read.schema(self._with_part).option("basePath", self.path)
        rows, visible = reader.parquet(*paths), self._visible()
        rows = rows if visible is None else rows.filter(visible)
        return rows if parts else rows.select(*self.schema.names)

    def read(self, without: str | None = None) -> DataFrame:
        """All rows, or all but those of a run that is in no merge yet."""
        rows = self._of([self.path], parts=True)
        return (rows.filter(F.col("part") != without) if without else rows).select(*self.schema.names)

    def read_days(self, days: Iterable, run: str | None = None, without: str | None = None) -> DataFrame:
        """Some days' rows, of one run or without one if it is named; only these folders are listed."""
        wanted = {f"{self.day}={d}" for d in days}
        found = [d for d in self.days() if d in wanted]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        rows = self._of([f"{self.path}/{d}" for d in found], parts=True)
        rows = rows.filter(F.col("part") != without) if without else rows
        return (rows if run is None else rows.filter(F.col("part") == run)).select(*self.schema.names)

    def run(self, run: str) -> DataFrame:
        """A run's rows, from the newest day that has any; of a run that is in no merge yet."""
        for day in self.days():
            if f"part={run}" in self.files.names(f"{self.path}/{day}"):
                return self._of([f"{self.path}/{day}/part={run}"])
        return self.spark.createDataFrame([], self.schema)

    def runs_after(self, run: str) -> DataFrame | None:
        """Parts with later runs of the lane, some of them merged with earlier ones; None if there are none.

        Days are looked at newest first until one has none.
        """
        later = []
        for day in self.days():
            own = [p for p in self._parts(day) if p[0] == run[0] and first_last(p)[1][:RUN] > run]
            if not own:
                break
            later += [f"{self.path}/{day}/part={p}" for p in own]
        return self._of(later) if later else None

    def newest(self, n: int, wanted: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """The newest days that hold ``n`` rows between them, or all: the newest ``n`` rows by a time of that day are inside.

        Days are asked one after another, newest first, and no more than are needed.
        """
        found, rows = [], 0
        for day in self.days():
            value = day.split("=", 1)[1]
            found.append(value)
            rows += wanted(self.read_days([value])).limit(n).count()
            if rows >= n:
                break
        return wanted(self.read_days(found))

    def newest_run(self, lane: str) -> str | None:
        """The newest run of a lane among the newest day's parts, or an earlier day's if that has none."""
        for day in self.days():
            names = [last for p in self._parts(day) if (last := first_last(p)[1])[0] == lane]
            if names:
                return max(names)[:RUN]
        return None

    def _parts(self, day: str) -> list[str]:
        names = (n.removeprefix("part=") for n in self.files.names(f"{self.path}/{day}") if n.startswith("part="))
        return sorted(names, key=first_last)

    def merge(self, target: int = TARGET_BYTES, before: str | None = None) -> int:
        """Merge small parts; returns how many went into others. Runs from ``before`` on are left alone.

        One job writes the merged parts of all days. One merge runs at a time.
        """
        self._clean()
        parts = {day: self._parts(day) for day in self.days()}
        newest: dict[str, str] = {}
        for name in (first_last(p)[1][:RUN] for own in parts.values() for p in own):
            newest[name[0]] = max(newest.get(name[0], ""), name)
        if before and before[0] in newest:
            newest[before[0]] = min(newest[before[0]], before)
        bins = [(day, group) for day, own in parts.items() for group in self._bins(day, own, newest, target)]
        if not bins:
            return 0
        merged = [(day.split("=", 1)[1], f"{first_last(group[0])[0]}~{first_last(group[-1])[1]}") for day, group in bins]
        for day, name in merged:
            self.files.mark(f"{self.swaps}/pending@{day}@{name}")
        rows = self._of([f"{self.path}/{day}/part={p}" for day, group in bins for p in group], parts=True)
        inside = F.lit(None).cast("string")
        for day, name in merged:
            own = (F.col(self.day).cast("string") == day) & F.col("part").between(*first_last(name))
            inside = F.when(own, name).otherwise(inside)
        self._writer(rows.withColumn("part", inside).hint("rebalance", self.day, "part")).mode("append").parquet(self.path)
        for day, name in merged:
            self.files.mark(f"{self.swaps}/done@{day}@{name}")
        return sum(len(group) for _, group in bins)

    def _bins(self, day: str, parts: list[str], newest: dict[str, str], target: int) -> Iterator[list[str]]:
        """Small parts of a lane that follow each other, in groups of two or more up to the target size."""
        group, size = [], 0
        for part in parts:
            whole = first_last(part)[1][:RUN] < newest[part[0]]
            own = self.files.size(f"{self.path}/{day}/part={part}") if whole else target
            if own >= target or size + own > target or (group and group[-1][0] != part[0]):
                if len(group) > 1:
                    yield group
                group, size = [], 0
            if own < target:
                group.append(part)
                size += own
        if len(group) > 1:
            yield group

    def _clean(self) -> None:
        """Remove what the last merge replaced, or left unfinished."""
        pending, done = self._marks()
        for day, merged in pending:
            self.files.delete(f"{self.path}/{self.day}={day}/part={merged}")
            self.files.delete(f"{self.swaps}/pending@{day}@{merged}")
        for day, merged in done:
            first, last = first_last(merged)
            for name in self.files.names(f"{self.path}/{self.day}={day}"):
                part = name.removeprefix("part=")
                if first <= part <= last and part != merged:
                    self.files.delete(f"{self.path}/{self.day}={day}/{name}")
            for mark in ("pending", "done"):
                self.files.delete(f"{self.swaps}/{mark}@{day}@{merged}")


def _any(conditions: list[Column]) -> Column:
    """The conditions joined by or, as a balanced tree."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2])
        conditions = [a | b for a, b in pairs] + (conditions[-1:] if len(conditions) % 2 else [])
    return conditions[0]


class VersionTable:
    """A table replaced as a whole: a folder per version, and an empty file that names the one that counts.

    Readers take the version that counts when they begin, and find it until the next but one is there.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType):
        self.spark, self.schema, self.files = spark, schema, Files(spark)
        self.path, self.marks = f"{root}/{name}", f"{root}/versions/{name}"

    def create(self, rows: DataFrame | None = None) -> None:
        for folder in (self.path, self.marks):
            self.files.delete(folder)
        self.replace(self.spark.createDataFrame([], self.schema) if rows is None else rows)

    @property
    def version(self) -> int:
        """The number of the version that counts; 0 before there is one."""
        return int((self.files.names(self.marks) or ["0"])[-1])

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:09d}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(version or self.version))

    def append(self, rows: DataFrame) -> None:
        """Add to the version that counts."""
        rows.write.mode("append").parquet(self._folder(self.version))

    def replace(self, rows: DataFrame) -> int:
        """Write a new version, then let it count; a lost attempt is written over by the next."""
        last = self.version
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(last + 1))
        self.files.mark(f"{self.marks}/{last + 1:09d}")
        for name in self.files.names(self.marks)[:-2]:
            self.files.delete(self._folder(int(name)))
            self.files.delete(f"{self.marks}/{name}")
        return last + 1
