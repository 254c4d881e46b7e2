"""Near-duplicate groups: a set similarity join by chosen paths over minwise hashes.

Each text's set of word shingles has a sketch of minwise hashes. A tree branches: at a node, a few
coordinates are chosen by the node's name, and the texts that agree in a chosen coordinate go to the
same child. A pair of similarity s goes on to a given child with probability s; two children on the first
levels keep it alive, one child on the later ones keeps large nodes from multiplying while dissimilar
texts part. Small nodes are compared exhaustively, large ones branch again, and trees raise recall: each
has coordinates of its own, so their misses are independent. A pair that meets only in large nodes on all
levels is missed by a tree with a probability of about 0.12 for s = 0.85 and 0.23 for s = 0.80, by five
trees with about 1 in 40,000 and 1 in 1,600.

Every link is confirmed on the full sets, after the sketches of a pair agree enough. Equal sets are one
text throughout. Only links that join groups matter: members of a node are first compared with one of
them and then with another, and nodes whose members are then of one group are done with. In the
nodes that are left, a task compares the sketches of members of different groups and keeps the members
that have a likely partner; their texts are then compared in full, pairs that have come into one group
meanwhile no more, and what leaves the task is a forest. So no step puts out pairs by the square of a node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelog.llm.common import digest, likely, only, small_batches, stored, utf8
from gatelog.llm.graph import components
from gatelog.llm.shingles import distinct, mixed, shingles, sketches

#: Coordinates that a tree branches by, trees (256 at most), most members of a node compared exhaustively,
#: and children per node by level; after the last level a node is compared whatever its size.
COORDINATES, TREES, SMALL, CHILDREN = 32, 5, 32, (2, 2, 1, 1, 1)
#: Levels on which members are compared with one of them (with two on the first); members of a node that a task compares by sketches,
#: and in full, with those of another such part at most, and shingle bytes of the latter (about).
STARS, SKETCHED, WHOLE, WHOLE_BYTES = 1, 2048, 1024, 16 << 20
#: Members that a task compares with one text.
CHUNK = 512
#: One-byte coordinates that estimate a similarity. A pair is compared in full unless they agree in less
#: than the similarity minus the slack, four standard deviations.
BYTES, SLACK = 192, 0.115
#: Text bytes worked on at a time.
BATCH_BYTES = 1 << 20


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_BYTES``."""
    return ranges([len(t) for t in texts])


def ranges(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges whose sizes sum up to about ``BATCH_BYTES``."""
    start = size = 0
    for i, own in enumerate(sizes):
        size += own
        if size >= BATCH_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def sketched(docs: DataFrame, key: str, text: str, size: int, trees: int = TREES) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, set_key (equal for equal sets), sketch, fine."""
    source = docs.select(F.col(key).alias("doc_id"), digest(utf8(F.col(text))).alias("text_key"), utf8(F.col(text)).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for start, end in ranges(pc.binary_length(texts).to_pylist()):
                values, begins = shingles(texts.slice(start, end - start).to_pylist(), size)
                some = np.diff(begins) > 0
                whole, short = sketches(values, begins, COORDINATES * trees, BYTES)
                rows = iter(zip(whole.view(np.int32), short, strict=True))
                counts, names, own, fine = [], [], [], []
                for i, has in enumerate(some):
                    members = np.unique(values[begins[i] : begins[i + 1]])
                    counts.append(len(members))
                    sums = [int(mixed(members, salt).sum()) for salt in (101, 202)]
                    names.append(b"".join(s.to_bytes(8, "big") for s in sums) if has else None)
                    row = next(rows) if has else (None, None)
                    own.append(row[0])
                    fine.append(row[1].tobytes() if has else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        batch.column(1).slice(start, end - start),
                        pa.array(counts, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(own, pa.list_(pa.int32())),
                        pa.array(fine, pa.binary()),
                    ],
                    ["doc_id", "text_key", "n_shingles", "set_key", "sketch", "fine"],
                )

    columns = "text_key binary, n_shingles long, set_key binary, sketch array<int>, fine binary"
    return source.mapInArrow(run, f"doc_id {kind}, {columns}")


def texts_of(units: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The texts of some units, one each: few others leave the scan, copies go before the shuffle."""
    named = units.select(F.col("unit").alias("text_key")).distinct()
    whole = docs.select(digest(utf8(F.col(text))).alias("text_key"), utf8(F.col(text)).alias("text"))
    once = likely(whole, "text_key", named).dropDuplicates(["text_key"])
    return stored(once.join(named, "text_key").select(F.col("text_key").alias("unit"), "text"))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity: 100 · |a ∩ b| ≥ percent · |a ∪ b|."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed(pairs: DataFrame, docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; few different a, many b each.

    A text a goes with each chunk of its partners once, so neither a frequent a nor its text weighs on one task.
    """
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("unit")), docs, text)
    chunks = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")))
    dealt = pairs.join(chunks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), "b")
    members = dealt.join(texts.withColumnRenamed("unit", "b"), "b").select("a", "chunk", "b", "text")
    first = chunks.join(texts.withColumnRenamed("unit", "a"), "a")
    first = first.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("binary").alias("b"), "text")
    placed = first.union(members).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.empty(0, np.uint64)
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            partner, column = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                own = distinct([column[i].as_py()], size)[0]
                if partner[i].is_valid:
                    keep[i] = alike(known, own, percent)
                else:
                    known = own
            yield pa.RecordBatch.from_arrays([batch.column(0), partner], ["a", "b"]).filter(pa.array(keep))

    return stored(placed.select("a", "chunk", "b", "text").mapInArrow(run, "a binary, b binary"))


def _node(name: Column, tree: Column) -> Column:
    """A node's number; its last byte is the tree."""
    return F.shiftleft(name, 8).bitwiseOR(tree)


def roots(trees: int) -> list[Column]:
    return [_node(F.xxhash64(F.lit(f"tree {t}")), F.lit(t).cast("long")) for t in range(trees)]


def children(node: Column, level: int) -> list[Column]:
    """A text's children of a node by its ``sketch``, each by another of the tree's coordinates, chosen by the node's name."""
    tree = node.bitwiseAND(F.lit(255).cast("long"))
    first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(COORDINATES))
    step = F.pmod(F.xxhash64(node, F.lit(2)), F.lit(COORDINATES - 1)) + 1
    places = [tree * COORDINATES + F.pmod(first + step * i, F.lit(COORDINATES)) for i in range(CHILDREN[level])]
    return [_node(F.xxhash64(node, place, F.get("sketch", place.cast("int"))), tree) for place in places]


def _mixed_nodes(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds each member's group so far (grp) and the node's size (n); nodes whose members are all of one group go."""
    named = stored(rows.join(groups, "unit", "left").select("node", "unit", F.coalesce("component", "unit").alias("grp")))
    nodes = named.groupBy("node").agg(F.min("grp").alias("l"), F.max("grp").alias("g"), F.count("*").alias("n"))
    return stored(named.join(stored(nodes.where("l <> g").select("node", "n")), "node"))


def _stars(rows: DataFrame, order: Column) -> DataFrame:
    """The node's member that comes first, and each member of another group."""
    first = rows.groupBy("node").agg(F.min(F.struct(order.alias("order"), "unit", "grp")).alias("first"))
    both = rows.join(stored(first), "node").where("grp <> first.grp")
    return both.select(F.col("first.unit").alias("a"), F.col("unit").alias("b")).distinct()


@F.arrow_udf(T.IntegerType())
def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """In how many bytes two sketches agree."""
    left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), BYTES) for x in (a, b))
    return pa.array((left == right).sum(axis=1), pa.int32())


def _agreeing(pairs: DataFrame, fine: DataFrame, least: int) -> DataFrame:
    """The pairs whose sketches agree in at least so many bytes."""
    fa, fb = (fine.select(F.col("unit").alias(x), F.col("fine").alias(f"f{x}")) for x in "ab")
    met = pairs.join(fa, "a").join(fb, "b")
    return stored(met.where(_same("fa", "fb") >= least).select("a", "b"))


def _cells(rows: DataFrame, parts: Column) -> DataFrame:
    """Members dealt into cells (node, i, j) of the node's parts i and j, in place of n; ``part`` is the own part.

    Any two members meet in a cell: those of a part in (part, part) and, like those of two parts, in (i, j).
    """
    own = F.pmod(F.xxhash64("unit"), F.col("parts")).cast("int")
    cell = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(F.least("part", x).alias("i"), F.greatest("part", x).alias("j"))
    )
    dealt = rows.withColumn("parts", parts.cast("int")).withColumn("part", own).withColumn("cell", F.explode(cell))
    return dealt.select("node", "cell.i", "cell.j", "part", "unit", "grp")


def _in_cells(placed: DataFrame, run, schema: str) -> DataFrame:
    """Runs ``run`` on the members (part, unit, grp, more) of each cell of rows (node, i, j, part, unit, grp, more)."""
    columns = placed.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, members = None, []
        for batch in batches:
            for node, i, j, *member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (node, i, j) != last:
                    if members:
                        yield run(*last, members)
                    last, members = (node, i, j), []
                members.append(member)
        if members:
            yield run(*last, members)

    ordered = placed.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "unit")
    return ordered.select(*columns).mapInArrow(each, schema)


class Cell:
    """The members of a cell with their sketches, and their groups as far as they are known."""

    def __init__(self, i: int, j: int, members: list[tuple]):
        self.part = np.array([m[0] for m in members])
        self.i, self.j = i, j
        _, self.group = np.unique(np.array([m[2] for m in members], dtype=object).astype("S16"), return_inverse=True)
        self.fine = np.frombuffer(b"".join(m[3] for m in members), np.uint8).reshape(len(members), BYTES)

    def partners(self, row: int, least: int) -> np.ndarray:
        """Later members of another group, of the other part in a cell of two, whose sketches agree enough."""
        if self.i == self.j:
            others = np.arange(row + 1, len(self.part))
        else:
            others = np.flatnonzero(self.part == self.j) if self.part[row] == self.i else np.empty(0, np.int64)
        others = others[self.group[others] != self.group[row]]
        return others[(self.fine[others] == self.fine[row]).sum(axis=1) >= least]


def _likely_members(rows: DataFrame, fine: DataFrame, least: int) -> DataFrame:
    """The members (node, unit, grp, fine) that have a likely partner of another group in their node."""

    def run(node: int, i: int, j: int, members: list[tuple]) -> pa.RecordBatch:
        cell, found = Cell(i, j, members), np.zeros(len(members), bool)
        for row in range(len(members)):
            partners = cell.partners(row, least)
            found[partners] = True
            found[row] |= len(partners) > 0
        kept = [members[k] for k in np.flatnonzero(found)]
        columns = [pa.array([node] * len(kept), pa.int64()), *(pa.array([m[k] for m in kept], pa.binary()) for k in (1, 2, 3))]
        return pa.RecordBatch.from_arrays(columns, ["node", "unit", "grp", "fine"])

    placed = _cells(rows, F.ceil(F.col("n") / SKETCHED)).join(fine, "unit").select("node", "i", "j", "part", "unit", "grp", "fine")
    found = stored(_in_cells(placed, run, "node long, unit binary, grp binary, fine binary"))
    return found.dropDuplicates(["node", "unit"])


def _forest(members: DataFrame, sizes: DataFrame, docs: DataFrame, text: str, size: int, percent: int, least: int) -> DataFrame:
    """Links (a, b) that join the groups of members (node, unit, grp, fine): per cell no more than members."""
    texts = texts_of(members, docs, text)
    weighed = members.join(sizes, "unit")
    nodes = weighed.groupBy("node").agg(F.count("*").alias("n"), F.sum(8 * F.col("n_shingles")).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / WHOLE), F.ceil(F.col("bytes") / WHOLE_BYTES))
    cells = _cells(members.drop("fine").join(stored(nodes), "node"), parts)
    fine = members.select("unit", "fine").dropDuplicates(["unit"])
    placed = cells.join(fine, "unit").join(texts, "unit").select("node", "i", "j", "part", "unit", "grp", "fine", "text")

    def run(node: int, i: int, j: int, members: list[tuple]) -> pa.RecordBatch:
        cell, found, known = Cell(i, j, members), [], {}

        def whole(k: int) -> np.ndarray:
            if k not in known:
                known[k] = distinct([members[k][4]], size)[0]
            return known[k]

        for row in range(len(members)):
            for k in cell.partners(row, least):
                if cell.group[k] != cell.group[row] and alike(whole(row), whole(k), percent):
                    found.append((members[row][1], members[k][1]))
                    cell.group[cell.group == cell.group[k]] = cell.group[row]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return stored(_in_cells(placed, run, "a binary, b binary"))


def grouped(docs: DataFrame, key: str, text: str, size: int, percent: int, trees: int) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component (a key of the group; null without shingles)."""
    small_batches(docs.sparkSession)
    rows = stored(sketched(docs, key, text, size, trees))
    units = stored(
        rows.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min(F.struct("text_key", "sketch", "fine", "n_shingles")).alias("first"))
        .select("set_key", F.col("first.text_key").alias("unit"), "first.sketch", "first.fine", "first.n_shingles")
    )
    sketch, fine, sizes = units.select("unit", "sketch"), units.select("unit", "fine"), units.select("unit", "n_shingles")
    least = round((percent / 100 - SLACK) * BYTES)

    def linked(stars: DataFrame) -> DataFrame:
        return confirmed(_agreeing(stars, fine, least), docs, text, size, percent)

    def closed(links: DataFrame) -> DataFrame:
        return stored(components(links).withColumnRenamed("node", "unit"))

    left = stored(sketch.select("unit", F.explode(F.array(*(c for r in roots(trees) for c in children(r, 0)))).alias("node")))
    alone = units.select("unit", F.col("unit").alias("component"))
    links = units.limit(0).select(F.col("unit").alias("a"), F.col("unit").alias("b"))  # a local frame would start workers of its own
    so_far, small = alone, None
    for level in range(len(CHILDREN)):
        nodes = _mixed_nodes(left, so_far)
        for order in ([F.col("unit")] if level == 0 else []) + [F.xxhash64("unit", F.lit(level))] * (level < STARS):
            found = linked(_stars(nodes, order))
            if not found.isEmpty():
                links = links.union(found)
                so_far = closed(links)
                nodes = _mixed_nodes(nodes.select("node", "unit"), so_far)
        few = nodes.where(F.col("n") <= SMALL)
        small = few if small is None else small.union(few)
        large = nodes.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        if level + 1 == len(CHILDREN):
            small = small.union(large)
            break
        wide = large.select("node", "unit").join(sketch, "unit")
        left = stored(wide.select("unit", F.explode(F.array(*children(F.col("node"), level + 1))).alias("node")))
    members = stored(_likely_members(_mixed_nodes(small.select("node", "unit"), so_far), fine, least))
    if not members.isEmpty():
        so_far = closed(links.union(_forest(members, sizes, docs, text, size, percent, least)))
    named = units.join(so_far, "unit", "left").select("set_key", F.coalesce("component", "unit").alias("component"))
    return rows.drop("sketch", "fine").join(stored(named), "set_key", "left").select("doc_id", "text_key", "n_shingles", "component")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 85, trees: int = TREES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, text_key.

    Texts are linked if their sets of ``size``-word shingles have a Jaccard similarity of at least
    ``percent`` in a hundred; components are closed over links. ``component_id`` is the least ``key`` of
    the component (nulls ignored; null if all are), ``kept`` whether it is the row's own. Null, empty and
    blank texts have no shingles and are linked with nothing. Repeated rows are one text and share all
    results. An empty table gives no rows. Only ``key`` and ``text`` are read.
    """
    rows = stored(grouped(docs, key, text, size, percent, trees))
    ids = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(stored(ids), "component", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "text_key"
    )


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stay, with all their columns: one of each component, that with the least ``key``.

    Of a component's rows with the least key, those of one text; where all keys are null, those of one text too.
    Of rows alike in ``key`` and text one stays. Texts without shingles are no component: all stay, once for each key.
    """
    rows = stored(grouped(docs, key, text, size, percent, TREES))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = rows.where("component is not null").groupBy("component").agg(F.min(order).alias("first"))
    kept = first.select("first.doc_id", "first.text_key").union(rows.where("component is null").select("doc_id", "text_key"))
    return only(docs, kept, doc_id=F.col(key), text_key=digest(utf8(F.col(text))))
