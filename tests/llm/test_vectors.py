"""Hard negatives and vector codes against plain Python over whole tables."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatelog.llm import hard_negatives, vector_codes
from gatelog.llm.vectors import exact_products, packed, unpacked

SCHEMA = "vec_id long, embedding array<double>, label int, score string, qid string, part string, v string, code string"


def table(spark, rows, partitions=5):
    clash = ("score", "qid", "part", "v", "code")
    return spark.createDataFrame([(*r, *clash) for r in rows], SCHEMA).repartition(partitions)


def odd_rows(dims):
    """Null and broken vectors, null labels and ids, ties, copies, and a vector that a third of the rows share."""
    chance = random.Random(5)
    rows = [(i, [chance.gauss(0, 0.2) for _ in range(dims)], chance.randrange(4)) for i in range(400)]
    hot = [0.25] * dims
    rows += [(i, hot, i % 4) for i in range(400, 600)]
    rows += [(7, None, 1), (50, [math.nan] * dims, 2), (51, [math.inf] + [0.0] * (dims - 1), 2), (52, [None] * dims, 0)]
    rows += [(100, [0.1] * dims, None), (None, hot, 1), (None, [0.2] * dims, 3)]
    rows += [rows[0], rows[0], rows[50], (50, [0.3] * dims, 1), (701, [-0.0] * dims, 2), (750, [0.0] * dims, 0)]
    return rows


def whole(rows):
    out = []
    for key, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            out.append((key, tuple(math.floor(256 * x) for x in vector), label))
    return out


def mined(rows):
    """All scores of all anchors."""
    points = sorted({(k, v, la) for k, v, la in whole(rows) if la is not None}, key=repr)
    last = float("inf")
    out = []
    for anchor in points:
        if anchor[0] is None or anchor[0] % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(anchor[1], p[1], strict=True)), last if p[0] is None else p[0], p) for p in points if p != anchor
        ]
        scored.sort(key=lambda s: s[:2])
        for score, key, _ in [s for s in scored if s[2][2] == anchor[2]][:5]:
            inside = [s for s in scored if s[2][2] != anchor[2] and -50 * score <= -100 * s[0] <= -95 * score][:3]
            out += [(anchor[0], key, i + 1, n[1], -score, -n[0]) for i, n in enumerate(inside)]
    return sorted(tuple(None if x == last else x for x in row) for row in out)


def mine(df):
    result = hard_negatives.mine(df, F.col("vec_id"), F.col("label"), "embedding", F.col("vec_id") % 50 == 0)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in result.collect()), key=lambda r: tuple(2**63 if x is None else x for x in r))


def in_order(rows):
    return sorted(rows, key=lambda r: tuple(2**63 if x is None else x for x in r))


@pytest.mark.parametrize("scale", [1, 1 << 21], ids=["floats", "integers"])
def test_mined_as_by_all_scores(spark, scale):
    rows = [(k, v and [x if x is None else x * scale for x in v], la) for k, v, la in odd_rows(8)]
    want = in_order(mined(rows))
    assert mine(table(spark, rows)) == want and len(want) > 50


def test_mined_over_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    monkeypatch.setattr(hard_negatives, "FAN", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK", 4)
    rows = odd_rows(4)
    assert mine(table(spark, rows)) == in_order(mined(rows))


def test_search_opens_few_leaves_of_clustered_rows(monkeypatch):
    """Boxes outside the window or below the k-th score stay closed, and nothing is lost."""
    monkeypatch.setattr(hard_negatives, "LEAF", 32)
    chance = np.random.default_rng(3)
    centres = chance.integers(-4000, 4000, (40, 6))
    x = (centres[chance.integers(0, 40, 20_000)] + chance.integers(-9, 9, (20_000, 6))).astype(float)
    labels = chance.integers(0, 5, 20_000)
    opened = []

    class Counted(hard_negatives.Search):
        def leaf(self, node, rows):
            opened.append((node, len(rows)))
            super().leaf(node, rows)

    leaves = [(own, labels[own], x[own]) for own in hard_negatives.tiles(x, labels)]
    assert sorted(np.concatenate([own for own, _, _ in leaves])) == list(range(20_000))
    tree = hard_negatives.Tree(leaves)
    q, own = x[:32], labels[:32]
    scores = q @ x.T
    top = np.sort(scores, axis=1)[:, -1]
    floor, ceiling = np.floor(top * 0.5)[:, None], np.floor(top * 0.95)[:, None]
    found = Counted(tree, q, own, floor, ceiling, 3, False)
    for i in range(32):
        fits = [j for j in range(20_000) if labels[j] != own[i] and floor[i, 0] <= scores[i, j] <= ceiling[i, 0]]
        best = sorted(fits, key=lambda j: (-scores[i, j], j))[:3]
        assert found.ids[i, 0][found.found[i, 0]].tolist() == best
    assert sum(n for _, n in opened) < 0.5 * 32 * len(leaves)


def test_nothing_to_mine(spark):
    assert mine(table(spark, [])) == []
    assert mine(table(spark, [(50, None, 1), (100, [0.1] * 4, None)])) == []
    assert mine(table(spark, [(50, [0.1] * 4, 1)])) == []
    with pytest.raises(Exception, match="different lengths"):
        mine(table(spark, [(50, [0.1] * 4, 1), (51, [0.1] * 3, 1)]))


def coded(rows, parts=16, entries=64):
    points = whole(rows)
    order = sorted(points, key=lambda p: (p[0] is None, p[0] or 0, packed(np.array([p[1]]))[0]))[:entries]
    step = len(points[0][1]) // parts
    cut = lambda v, p: v[p * step : (p + 1) * step]
    books = [[cut(v, p) for _, v, _ in order] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(2):
        found = [[near(v, p)[1] for p in range(parts)] for _, v, _ in points]
        for p in range(parts):
            members = defaultdict(list)
            for (_, v, _), own in zip(points, found, strict=True):
                members[own[p]].append(cut(v, p))
            for entry, own in members.items():
                books[p][entry] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    result, errors = [], defaultdict(int)
    for key, v, label in points:
        best = [near(v, p) for p in range(parts)]
        result.append([key, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), label])
        errors[label] += result[-1][2]
    return [(k, c, e, errors[la], sha) for k, c, e, la in result]


@pytest.mark.parametrize("scale", [1, 1 << 17], ids=["one limb", "two limbs"])
def test_codes_as_by_plain_integers(spark, scale):
    rows = [(k, v and [x if x is None else x * scale for x in v], la) for k, v, la in odd_rows(32)]
    got = vector_codes.codes(table(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(coded(rows), key=repr)


def test_codes_of_few_rows(spark):
    assert vector_codes.codes(table(spark, [])).collect() == []
    assert vector_codes.codes(table(spark, [(1, None, 1)])).collect() == []
    rows = [(2, [0.5] * 16, 1), (2, [0.5] * 16, 1), (None, [-0.5] * 16, None)]
    assert sorted((tuple(r) for r in vector_codes.codes(table(spark, rows)).collect()), key=repr) == sorted(coded(rows), key=repr)
    for bad in ([(1, [0.5] * 15, 1)], [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], [(1, [1e9] * 16, 1)], [(1, [], 1)]):
        with pytest.raises(Exception, match="compon|parts"):
            vector_codes.codes(table(spark, bad)).collect()


def test_limbs_lose_nothing():
    chance = np.random.default_rng(1)
    for bits in (8, 21, 22, 30):
        a, b = (chance.integers(-(1 << bits), 1 << bits, (5, 3000)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
        wrapped = [[(w + 2**63) % 2**64 - 2**63 for w in row] for row in want]
        assert exact_products(a, b).tolist() == wrapped
    edges = np.array([[-(2**b), 2**b - 1, -1, 0] for b in (7, 8, 15, 16, 31, 32, 62)])
    assert (unpacked(packed(edges), 4) == edges).all() and len(packed(edges)[0]) == 4


def test_decoded():
    books = np.arange(12).reshape(2, 3, 2)
    assert vector_codes.decoded(bytes([2, 0]), books).tolist() == [4, 5, 6, 7]
