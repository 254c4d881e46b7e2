"""Hard negatives: rows of another label whose score lies in a window below a positive's score.

Rows are packed into R-trees by sort, tile and recurse: Spark sorts them by label and one coordinate into
parts, and within a part they are sorted and cut by one coordinate after another until a leaf is left.
A leaf and each node above it have a bounding box of coordinates and labels. The box gives an interval of
every coordinate's product with the query, so an interval of the score. A best-first queue opens the node
with the greatest possible score first and leaves out, query by query, boxes outside the score window or
strictly below the k-th score found, and boxes that hold no label wanted.

A part is a task's work; queries go to every part whose box may hold a result, each part gives its k best,
and the best of all parts are the result. One point in ``SAMPLE`` is indexed apart and searched first: its
k-th scores are the bounds that the search of the others starts from, so that parts put out few rows that
others beat. Boxes of parts are held by the driver, some hundred numbers for ``PART_ROWS`` rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatelog.llm.common import stored
from gatelog.llm.vectors import packed, unpacked, whole_numbers

#: Rows of a part at most (about), parts at least, rows of a leaf, children of a node, queries run together.
PART_ROWS, PARTS, LEAF, FAN, BLOCK = 1 << 18, 16, 256, 16, 1024
#: One point in so many is searched first.
SAMPLE = 16
#: Stands for a null id: after all others; and a score below all others.
LAST = 2**63 - 1
LOWEST = -(2**63 - 1)
INDEX = "part int, kind int, qid long, n int, ids binary, labels binary, body binary, windows array<long>, least array<long>"
FOUND = "qid long, window long, score long, id long, twin boolean"


def tiles(x: np.ndarray, labels: np.ndarray) -> Iterator[np.ndarray]:
    """The rows' numbers in leaves of at most ``LEAF``: sorted and cut by label, then by coordinates of widest spread."""
    todo = [(np.argsort(labels, kind="stable"), 3)]
    while todo:
        rows, sorts = todo.pop()
        if len(rows) <= LEAF:
            if len(rows):
                yield np.sort(rows)
            continue
        if sorts < 3:
            spread = x[rows].max(axis=0) - x[rows].min(axis=0)
            rows = rows[np.argsort(x[rows, int(spread.argmax())], kind="stable")]
        leaves = -(-len(rows) // LEAF)
        slabs = leaves if sorts <= 1 else int(np.ceil(leaves ** (1 / sorts)))
        size = LEAF * -(-leaves // slabs)
        todo.extend((rows[at : at + size], max(1, sorts - 1)) for at in reversed(range(0, len(rows), size)))


class Tree:
    """Leaves in packing order and the boxes of the nodes above them, level by level."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """``leaves`` are (ids ascending, labels, matrix)."""
        self.leaves = leaves
        low = np.array([m.min(axis=0) for _, _, m in leaves])
        high = np.array([m.max(axis=0) for _, _, m in leaves])
        marks = np.array([[own.min(), own.max()] for _, own, _ in leaves])
        self.levels = [(low, high, marks)]
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            marks = np.stack([np.minimum.reduceat(marks[:, 0], at), np.maximum.reduceat(marks[:, 1], at)], axis=1)
            self.levels.append((low, high, marks))

    @property
    def box(self):
        low, high, marks = self.levels[-1]
        return low[0], high[0], marks[0]


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that each query can have in each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def fitting(labels: np.ndarray, marks: np.ndarray, same: bool) -> np.ndarray:
    """Whether a box with these label bounds can hold the query's own label, or another one."""
    if same:
        return (marks[:, 0] <= labels[:, None]) & (labels[:, None] <= marks[:, 1])
    return (marks[:, 0] != labels[:, None]) | (labels[:, None] != marks[:, 1])


class Search:
    """The k best rows of a tree for each window of each query.

    ``floor`` and ``ceiling`` are queries × windows. ``best`` and ``ids`` hold the results, best first, equal
    scores by id; ``twin`` tells whether the row's vector is the query's.
    """

    def __init__(self, tree: Tree, q, labels, floor, ceiling, k: int, same: bool):
        self.tree, self.q, self.labels, self.same, self.k = tree, q, labels, same, k
        self.floor, self.ceiling = floor, ceiling
        self.none = none = -np.inf if q.dtype == np.float64 else LOWEST
        self.best = np.full((*floor.shape, k), none, q.dtype)
        self.ids = np.full((*floor.shape, k), LAST, np.int64)
        self.twin = np.zeros((*floor.shape, k), bool)
        self.found = np.zeros((*floor.shape, k), bool)
        self.run()

    def least(self) -> np.ndarray:
        """The lowest score that still matters, per query and window."""
        return np.maximum(self.floor, self.best[:, :, -1])

    def run(self) -> None:
        top = len(self.tree.levels) - 1
        queue = [(0, top, 0, np.arange(len(self.q)))]
        while queue:
            _, level, node, rows = heapq.heappop(queue)
            if level < 0:
                self.leaf(node, rows)
                continue
            low, high, marks = self.tree.levels[level]
            children = range(node * FAN, min(len(low), node * FAN + FAN)) if level < top else range(len(low))
            own = slice(children.start, children.stop)
            bottom, ceiling = intervals(self.q[rows], low[own], high[own])
            fits = fitting(self.labels[rows], marks[own], self.same)
            least = self.least()[rows]
            open_ = (ceiling[:, None, :] >= least[:, :, None]) & (bottom[:, None, :] <= self.ceiling[rows][:, :, None])
            open_ = open_.any(axis=1) & fits
            for i, child in enumerate(children):
                active = rows[open_[:, i]]
                if len(active):
                    # below the lowest level of boxes are the leaves; ties are opened in packing order
                    first = -ceiling[open_[:, i], i].max()
                    heapq.heappush(queue, (first, level - 1, child, active))

    def leaf(self, node: int, rows: np.ndarray) -> None:
        low, high, _ = (side[node : node + 1] for side in self.tree.levels[0])
        _, most = intervals(self.q[rows], low, high)  # the k-th score may have risen since the leaf was queued
        rows = rows[(most >= self.least()[rows]).any(axis=1)]
        if not len(rows):
            return
        ids, labels, matrix = self.tree.leaves[node]
        scores = self.q[rows] @ matrix.T
        fits = (labels == self.labels[rows][:, None]) == self.same
        for w in range(self.floor.shape[1]):
            least = np.maximum(self.floor[rows, w], self.best[rows, w, -1])
            take = fits & (scores >= least[:, None]) & (scores <= self.ceiling[rows, w][:, None])
            better = np.flatnonzero(take.any(axis=1))
            if not len(better):
                continue
            own = np.where(take[better], scores[better], self.none)
            order = np.argsort(-own, axis=1, kind="stable")[:, : self.k]  # columns are by id
            at, line = rows[better], np.arange(len(better))[:, None]
            twin = (matrix[order] == self.q[at][:, None, :]).all(axis=2)
            best = np.concatenate([self.best[at, w], own[line, order]], axis=1)
            found = np.concatenate([self.found[at, w], take[better][line, order]], axis=1)
            names = np.concatenate([self.ids[at, w], ids[order]], axis=1)
            both = np.concatenate([self.twin[at, w], twin], axis=1)
            pick = np.lexsort((names, -best, ~found), axis=1)[:, : self.k]
            self.best[at, w], self.ids[at, w] = best[line, pick], names[line, pick]
            self.twin[at, w], self.found[at, w] = both[line, pick], found[line, pick]


Span = Callable[[int], tuple[int, int]]


class Index:
    """Parts of points as stored leaves, and what all tasks need to know about them."""

    def __init__(self, points: DataFrame, rows: int, places: int, coordinate: int, number: type):
        self.places, self.number = places, number
        leaf_rows = _leaves(points, max(PARTS, -(-rows // PART_ROWS)), places, coordinate)
        self.leaves = stored(leaf_rows)
        boxes = self.leaves.where("kind = 2").select("part", "body", "labels").collect()
        self.parts = [r.part for r in boxes]
        sides = [unpacked([bytes(r.body)], 2 * places)[0] for r in boxes]
        self.low = np.array([s[:places] for s in sides]).reshape(-1, places)
        self.high = np.array([s[places:] for s in sides]).reshape(-1, places)
        self.marks = np.array([np.frombuffer(r.labels, np.int64) for r in boxes]).reshape(-1, 2)

    def search(self, queries: DataFrame, k: int, same: bool, span: Span) -> DataFrame:
        """The best rows of each part for each query and window: qid, window, score, id, twin.

        ``queries`` have qid, label, v, windows (numbers that ``span`` turns into the least and the greatest
        score) and least (for each window a score below which nothing matters).
        """
        places, number = self.places, self.number
        parts, low, high, marks = self.parts, self.low.astype(number), self.high.astype(number), self.marks

        def bounds(windows: list[list[int]], least: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
            width = max(map(len, windows))
            floor, ceiling = (np.full((len(windows), width), side, number) for side in (1, 0))  # nothing fits
            for i, own in enumerate(windows):
                for j, mark in enumerate(own):
                    bottom, ceiling[i, j] = span(mark)
                    floor[i, j] = max(bottom, least[i][j])
            return floor, ceiling

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    block = batch.slice(at, BLOCK)
                    labels = block.column(1).to_numpy(zero_copy_only=False)
                    q = unpacked(block.column(2).to_pylist(), places).astype(number)
                    floor, ceiling = bounds(block.column(3).to_pylist(), block.column(4).to_pylist())
                    bottom, most = intervals(q, low, high)
                    inside = (most[:, None, :] >= floor[:, :, None]) & (bottom[:, None, :] <= ceiling[:, :, None])
                    row, box = np.nonzero(inside.any(axis=1) & fitting(labels, marks, same))
                    picked = block.take(pa.array(row))
                    mark = pa.array([np.int64(x).tobytes() for x in labels[row]], pa.binary())
                    none = pa.nulls(len(row), pa.binary())
                    columns = [
                        pa.array(np.array(parts, np.int32)[box], pa.int32()), pa.array(np.ones(len(row)), pa.int32()),
                        picked.column(0), pa.array(np.ones(len(row)), pa.int32()), none, mark, *picked.columns[2:],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, INDEX_NAMES)

        def answered(tree: Tree, block: list) -> pa.RecordBatch:
            q = unpacked([b[1] for b in block], places).astype(number)
            labels = np.array([b[2] for b in block])
            floor, ceiling = bounds([b[3] for b in block], [b[4] for b in block])
            result = Search(tree, q, labels, floor, ceiling, k, same)
            row, window, _ = at = np.nonzero(result.found)
            marks_of = [block[r][3][w] for r, w in zip(row, window, strict=True)]
            columns = [
                pa.array(np.array([b[0] for b in block], np.int64)[row]), pa.array(marks_of, pa.int64()),
                pa.array(result.best[at].astype(np.int64)), pa.array(result.ids[at]), pa.array(result.twin[at]),
            ]
            return pa.RecordBatch.from_arrays(columns, ["qid", "window", "score", "id", "twin"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, leaves, tree, block = None, [], None, []
            for batch in batches:
                for own, kind, qid, n, ids, labels, body, *asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if own != part:
                        if block:
                            yield answered(tree, block)
                        part, leaves, tree, block = own, [], None, []
                    if kind == 0:
                        matrix = unpacked([body], n * places).reshape(n, places).astype(number)
                        leaves.append((np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), matrix))
                        continue
                    tree = tree or Tree(leaves)
                    block.append((qid, body, int.from_bytes(labels, "little", signed=True), *asked))
                    if len(block) == BLOCK:
                        yield answered(tree, block)
                        block = []
            if block:
                yield answered(tree, block)

        if not parts:
            return queries.sparkSession.createDataFrame([], FOUND)
        routed = queries.select("qid", "label", "v", "windows", "least").mapInArrow(sent, INDEX)
        both = self.leaves.where("kind = 0").unionByName(routed)
        placed = both.repartition(len(parts), "part").sortWithinPartitions("part", "kind", "qid")
        return placed.mapInArrow(run, FOUND)


def first(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first ``k`` of each key by score, then id, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best(sample: Index, rest: Index, queries: DataFrame, k: int, same: bool, span: Span) -> DataFrame:
    """The k best points for each query and window: qid, window, score, id, twin, rank."""
    lowest = F.transform("windows", lambda w: F.lit(LOWEST))
    early = stored(first(sample.search(queries.withColumn("least", lowest), k, same, span), k, "qid", "window"))
    full = early.where(F.col("rank") == k).groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("known"))
    known = F.coalesce("known", F.create_map().cast("map<long,long>"))
    least = F.transform("windows", lambda w: F.coalesce(F.try_element_at(known, w), F.lit(LOWEST)))
    late = rest.search(queries.join(full, "qid", "left").withColumn("least", least), k, same, span)
    return first(early.drop("rank").unionByName(late), k, "qid", "window")


INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def _leaves(points: DataFrame, parts: int, places: int, coordinate: int) -> DataFrame:
    """The points as leaves (kind 0, in packing order by qid) and the boxes of their parts (kind 2)."""
    names = ["id", "label", "v"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = unpacked(batch.column(2).to_pylist(), places)[:, coordinate] if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*names, "at"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [[], [], []]
        part = None
        for batch in batches:
            for i in range(3):
                rows[i].extend(batch.column(i).to_pylist())
            part = batch.column(3)[0].as_py() if batch.num_rows else part
        if not rows[0]:
            return
        ids, labels = np.array(rows[0], np.int64), np.array(rows[1], np.int64)
        order = np.lexsort((labels, ids))  # leaves keep this order, so that equal scores go by id
        ids, labels = ids[order], labels[order]
        x = unpacked([rows[2][i] for i in order], places)
        out = []
        for leaf, own in enumerate(tiles(x, labels)):
            body = packed(x[own].reshape(1, -1))[0]
            out.append((part, 0, leaf, len(own), ids[own].tobytes(), labels[own].tobytes(), body, None, None))
        edges = np.array([labels.min(), labels.max()]).tobytes()
        box = packed(np.concatenate([x.min(axis=0), x.max(axis=0)]).reshape(1, -1))[0]
        out.append((part, 2, 0, 0, None, edges, box, None, None))
        schema = pa.schema(list(zip(INDEX_NAMES, KINDS, strict=True)))
        for at in range(0, len(out), 256):
            columns = list(zip(*out[at : at + 256], strict=True))
            arrays = [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    known = points.select(*names).mapInArrow(cut, "id long, label long, v binary, at long")
    ranged = known.repartitionByRange(parts, "label", "at", F.xxhash64("v", "id"))
    return ranged.select(*names, F.spark_partition_id().alias("part")).mapInArrow(pack, INDEX)


KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _shape(rows: DataFrame) -> tuple[int, int, int, type] | None:
    """How many rows, their length, the coordinate of widest spread, and the type that scores are exact in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        for batch in batches:
            lengths = set(batch.column(0).to_pylist())
            if not lengths:
                continue
            if len(lengths) > 1 or (low is not None and {len(low)} != lengths):
                raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
            x = unpacked(batch.column(1).to_pylist(), lengths.pop())
            n += len(x)
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            columns = [pa.array([n], pa.int64()), *(pa.array([s.tolist()], pa.list_(pa.int64())) for s in (low, high))]
            yield pa.RecordBatch.from_arrays(columns, ["n", "low", "high"])

    sides = rows.select("places", "v").mapInArrow(run, "n long, low array<long>, high array<long>")
    by_place = sides.select("n", F.size("low").alias("places"), F.posexplode(F.arrays_zip("low", "high")).alias("place", "x"))
    found = (
        by_place.groupBy("place").agg(F.sum("n"), F.min("x.low"), F.max("x.high"), F.min("places"), F.max("places"))
        .orderBy("place").collect()
    )
    if not found:
        return None
    if any(r[4] != r[5] for r in found):
        raise ValueError("vectors of different lengths")
    spread = [r[3] - r[2] for r in found]
    most = max(max(abs(r[2]), abs(r[3])) for r in found)
    bound = len(found) * most * most
    if bound >= 1 << 63:
        raise ValueError("components are too large for 64-bit scores")
    number = np.float64 if bound < 1 << 53 else np.int64
    return found[0][1], len(found), int(np.argmax(spread)), number


def mine(
    rows: DataFrame, key: Column, label: Column, vector: str, anchor: Column,
    positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95), scale: int = 256,
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of the vectors floor(``scale`` · x). An anchor (a row where ``anchor`` is
    true) has as positives its first ``positives`` other rows of the same label, and for each of them the
    first ``negatives`` rows of other labels whose score is within ``percent`` of the positive's; greater
    scores come first, ties by smaller key, null keys last. Rows with a null label, or a vector that is null
    or holds a null, NaN or infinite component, take no part. Rows alike in key, label and vector are one
    row; a row of the same key but another vector is another row. An anchor without positives, and a
    positive without negatives, have no rows; so has an empty table. Vectors of different lengths, and
    components beyond 64-bit scores, raise. Other columns are not read.
    """
    low_percent, high_percent = percent
    spark = rows.sparkSession
    whole = whole_numbers(rows, vector, scale, id=F.coalesce(key, F.lit(LAST)).cast("long"), label=label.cast("long"), anchor=F.coalesce(anchor, F.lit(False)))
    known = stored(whole.where("label is not null").dropDuplicates(["id", "label", "v"]))
    shape = _shape(known)
    if not shape:
        names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], names)
    n, places, coordinate, number = shape
    # More rows of one vector and label than can be asked for are never a result.
    alike = Window.partitionBy("v", "label").orderBy("id")
    points = known.select("id", "label", "v", F.row_number().over(alike).alias("place")).where(F.col("place") <= max(positives + 1, negatives))
    points = stored(points.drop("place"))
    early = F.pmod(F.xxhash64("v"), F.lit(SAMPLE)) == 0
    sample = Index(points.where(early), n // SAMPLE, places, coordinate, number)
    rest = Index(points.where(~early), n - n // SAMPLE, places, coordinate, number)

    anchors = stored(known.where("anchor").withColumn("qid", F.monotonically_increasing_id()))
    asked = anchors.select("qid", "label", "v", F.array(F.lit(0).cast("long")).alias("windows"))
    near = best(sample, rest, asked, positives + 1, True, lambda _: (LOWEST, -LOWEST)).drop("rank")
    near = near.join(anchors.select("qid", F.col("id").alias("anchor_id")), "qid")
    others = first(near.where(~(F.col("twin") & (F.col("id") == F.col("anchor_id")))), positives, "qid")
    chosen = stored(others.select("qid", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    def span(score: int) -> tuple[int, int]:
        return -(-low_percent * score // 100), high_percent * score // 100

    windows = chosen.groupBy("qid").agg(F.sort_array(F.collect_set("positive_score")).alias("windows"))
    below = best(sample, rest, anchors.select("qid", "label", "v").join(windows, "qid"), negatives, False, span)
    below = below.select(F.col("qid").alias("own"), "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = chosen.join(below, (F.col("qid") == F.col("own")) & (F.col("positive_score") == F.col("window")))
    real = {n: F.nullif(n, F.lit(LAST)) for n in ("anchor_id", "positive_id", "negative_id")}
    return pairs.withColumns(real).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
