import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatelog.llm import near_dedup, shingles
from gatelog.llm.common import ARROW_BYTES
from gatelog.llm.graph import components


def sets_of(rows, size):
    out = []
    for _, text in rows:
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        some = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [tuple(words)] if words else []
        out.append(frozenset(some))
    return out


def by_hand(rows, size, percent):
    sets, root = sets_of(rows, size), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            root[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), own, doc_id == own))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def families(prose, members=9):
    """Near copies of several similarities, a chain, and a family larger than a small node."""
    rows = []
    for f in range(6):
        words = prose(f, 100).split()
        for m in range(members):
            copy = list(words)
            for k in range(m % 5):
                copy[(m * 13 + k * 29) % 100] = f"w{f}x{m}x{k}"
            rows.append((f * 100 + m, " ".join(copy)))
    chain = prose(77, 120).split()
    for step in range(8):
        rows.append((900 + step, " ".join(chain[step * 4 : 80 + step * 4])))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_same_as_all_pairs_compared(docs_of, prose, size, percent):
    rows = families(prose)
    assert rows_of(near_dedup.groups(docs_of(*rows), size=size, percent=percent)) == by_hand(rows, size, percent)


def test_large_nodes_branch_and_stay_whole(docs_of, prose, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "SKETCHED", 8)
    monkeypatch.setattr(near_dedup, "WHOLE", 5)
    monkeypatch.setattr(near_dedup, "CHUNK", 4)
    rows = families(prose, members=30)
    assert rows_of(near_dedup.groups(docs_of(*rows))) == by_hand(rows, 3, 85)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(near_dedup.groups(odd_docs)) == by_hand(rows, 3, 85)
    kept = near_dedup.dedupe(odd_docs)
    assert kept.columns == odd_docs.columns
    # one row of each family; null, empty and blank texts stay, repeated rows do not
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 5, 6, 7, 8, 11, 12}
    assert 2 not in {r.doc_id for r in kept.collect()} and 3 not in {r.doc_id for r in kept.collect()}


def test_empty_table(docs_of):
    assert near_dedup.groups(docs_of()).collect() == []


def test_words_of_texts_longer_than_a_block(monkeypatch, prose):
    texts = [prose(1, 300).encode(), b"", b" a ", prose(2, 50).encode(), b"x" * 500]
    want = shingles.shingles(texts, 3)
    monkeypatch.setattr(shingles, "CUT", 64)
    got = shingles.shingles(texts, 3)
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_trees_miss_independently(spark):
    """Pairs that agree in four of five coordinates and stay in large nodes: at most 1 in 500 is lost (1 in 1,600 expected)."""
    n, width = 20_000, near_dedup.COORDINATES * near_dedup.TREES
    chance = np.random.default_rng(3)
    a = chance.integers(0, 2**31 - 1, (n, width))
    b = np.where(chance.random((n, width)) < 0.8, a, a + 1)
    rows = [(i, x.tolist()) for side in (a, b) for i, x in enumerate(side)]
    nodes = spark.createDataFrame(rows, "pair int, sketch array<int>").repartition(8)
    first = F.array(*(c for r in near_dedup.roots(near_dedup.TREES) for c in near_dedup.children(r, 0)))
    nodes = nodes.withColumn("node", F.explode(first))
    for level in range(1, len(near_dedup.CHILDREN)):
        nodes = nodes.withColumn("node", F.explode(F.array(*near_dedup.children(F.col("node"), level))))
    met = nodes.groupBy("pair", "node").count().where("count > 1").select("pair").distinct().count()
    assert n - met <= n // 500, n - met


def mixed_family(prose, members, words=120):
    """Near copies with more and more edits: about a third of the pairs reach 0.85, a third lie just below."""
    import random

    chance = random.Random(8)
    base = prose(5, words).split()
    rows = []
    for m in range(members):
        copy = list(base)
        for k in chance.sample(range(words), chance.choice([0, 1, 1, 2, 3, 4, 6])):
            copy[k] = f"x{m}k{k}"
        rows.append((m, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_recall_on_a_large_mixed_family(docs_of, prose, size, percent):
    """All pairs compared: not a row differs, and what the last step confirms is a forest."""
    rows = mixed_family(prose, 400)
    want = by_hand(rows, size, percent)
    assert 10 < len({r[2] for r in want}) < 390
    assert rows_of(near_dedup.groups(docs_of(*rows, partitions=6), size=size, percent=percent)) == want


def test_cells_put_out_a_forest():
    """A node's cell gives fewer links than members, whatever the number of linked pairs."""
    chance = np.random.default_rng(2)
    fine = chance.integers(0, 256, near_dedup.BYTES, dtype=np.uint8).tobytes()
    members = [(0, bytes([k] * 16), bytes([k] * 16), fine) for k in range(50)]
    cell = near_dedup.Cell(0, 0, members)
    assert sum(len(cell.partners(r, near_dedup.BYTES)) for r in range(50)) == 50 * 49 // 2
    two = near_dedup.Cell(0, 1, [(k % 2, *m[1:]) for k, m in enumerate(members)])
    assert sum(len(two.partners(r, near_dedup.BYTES)) for r in range(50)) == 25 * 25


def test_dedupe_with_null_and_repeated_ids(docs_of, prose):
    base = prose(3, 100)
    near = [base + f" tail{i}" for i in range(3)]
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (7, prose(4, 90)), (7, prose(4, 90) + " end"), (8, prose(4, 90))]
    kept = near_dedup.dedupe(docs_of(*rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 7), (True, None)]


BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unbounded(spark):
    before = spark.conf.get(BOUND, None)
    spark.conf.unset(BOUND)
    yield
    spark.conf.unset(BOUND)
    if before is not None:
        spark.conf.set(BOUND, before)


def test_workers_get_batches_of_bounded_bytes(spark, docs_of, unbounded):
    few = docs_of((1, "a b c"), (2, "a b c"))
    near_dedup.dedupe(few).collect()

    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"n": [batch.nbytes]})

    texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))  # 8 MB in a task
    found = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 8_000_000 and max(found) <= 2 * ARROW_BYTES


def test_a_callers_bound_on_batches_holds(spark, docs_of, unbounded):
    spark.conf.set(BOUND, "123456")
    near_dedup.dedupe(docs_of((1, "a b c"))).collect()
    assert spark.conf.get(BOUND) == "123456"


def test_no_local_frame_with_workers_of_its_own(spark, docs_of, prose, monkeypatch):
    text = prose(3, 60)
    docs = docs_of((1, text), (2, text + " end"), (3, prose(4, 60)))
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("a local frame"))
    assert sorted(r.doc_id for r in near_dedup.dedupe(docs).collect()) == [1, 3]


@pytest.mark.parametrize("n", range(6))
def test_few_words_in_all(n):
    """As in a small last batch."""
    values, begins = shingles.shingles([b"a b c"[: 2 * n]], 5)
    assert len(values) == begins[-1] == min(n, 1)
