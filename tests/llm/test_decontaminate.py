import random

import pytest

from gatelog.llm import decontaminate
from gatelog.llm.decontaminate import Index, plain

ITEMS = "item_id long, text string, extra string"


@pytest.fixture
def benchmark(spark, prose):
    texts = [f"{prose(300 + i, 20)}.\n{prose(400 + i, 12)}" for i in range(30)]
    rows = [*enumerate(texts), (90, None), (91, ""), (92, "..."), (93, texts[0]), (None, texts[1])]
    return spark.createDataFrame([(*r, "x") for r in rows], ITEMS)


def test_contained_items_are_found_and_halves_are_not(docs_of, benchmark, prose):
    texts = {r.item_id: r.text for r in benchmark.collect()}
    question = texts[4].split("\n")[0]
    docs = docs_of(
        (1, f"{prose(1, 500)} {texts[3]} {prose(2, 200)}"),
        (2, prose(3, 300)),
        (3, f"{prose(4, 90)} {question} {prose(5, 90)}"),
        (4, texts[5].upper().replace(".", " !")),
        (5, None), (6, ""), (7, "... !"),
        (8, f"{texts[6]} {prose(6, 3000)} {texts[7]}"), (8, texts[8]),
        (9, texts[0]), (10, texts[1]),
    )
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(1, 3), (4, 5), (8, 6), (8, 7), (8, 8), (9, 0), (9, 93), (10, 1), (10, None)}
    clean = decontaminate.remove_contaminated(docs, benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 5, 6, 7]


def test_walk_finds_exactly_what_scores_enough():
    chance = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(str(i), " ".join(chance.choices(vocabulary, k=12)), " ".join(chance.choices(vocabulary, k=6))) for i in range(200)]
    index = Index.build(items)
    for _ in range(60):
        query = sorted(chance.sample(range(len(index.terms)), chance.randrange(1, 40)))
        scores = {}
        for t in query:
            for item, impact in zip(*index.postings[t], strict=True):
                scores[item] = scores.get(item, 0) + impact
        for threshold in (0.2, 0.5, 0.8):
            assert dict(index.retrieve(query, threshold)).keys() == {i for i, s in scores.items() if s >= threshold}


def test_bounds_never_hide_a_match(prose):
    items = [(str(i), prose(600 + i, 30), prose(700 + i, 9)) for i in range(40)]
    index = Index.build(items)
    texts = [plain(f"{prose(i, i * 7)} {items[i][1]} {items[i][2]} {prose(50 + i, 40)}") for i in range(40)]
    assert all(str(i) in {index.names[k] for k in found} for i, found in enumerate(index.matches(texts)))


def test_the_threshold_lets_everything_through_that_could_be_verified(prose):
    """Leave out the heaviest words that verification allows to be missing: still retrieved."""
    items = [(str(i), prose(600 + i, 30 + i), prose(700 + i, 12)) for i in range(20)]
    index = Index.build(items)
    for k, name in enumerate(index.names):
        question, answer = items[int(name)][1:]
        less = " ".join(question.split()[5:]) + " " + " ".join(answer.split()[1:])
        own = index.parts[k]
        shares = [max(0, len(p) - n) / len(p) for p, n in zip(own, (5, 1), strict=True)]
        if all(s >= decontaminate.VERIFIED for s in shares):
            assert k in index.matches([plain(less)])[0]


def test_short_items(docs_of, spark):
    items = spark.createDataFrame([(1, "alpha beta", "q"), (2, "gamma", "q")], ITEMS)
    docs = docs_of((1, "x alpha beta y"), (2, "alpha x beta"), (3, "gamma"))
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} >= {(1, 1), (3, 2)}


def test_scores_do_not_depend_on_the_parts(docs_of, benchmark, prose, monkeypatch):
    texts = [r.text for r in benchmark.filter("item_id < 30").collect()]
    docs = docs_of(*[(i, f"{prose(i, 100)} {t} {prose(i + 40, 100)}") for i, t in enumerate(texts)])

    def pairs():
        found = decontaminate.contaminated(docs, benchmark).collect()
        return sorted((r.doc_id, -1 if r.item_id is None else r.item_id, round(r.score, 9)) for r in found)

    once = pairs()
    assert {d for d, _, _ in once} == set(range(30)) and len(once) == 32
    monkeypatch.setattr(decontaminate, "PART_BYTES", 900)
    parts = decontaminate.index_parts(decontaminate.named_items(benchmark))
    assert parts.count() > 3
    assert pairs() == once
    monkeypatch.setattr(decontaminate, "SCAN_BYTES", 1)
    assert pairs() == once
    assert decontaminate.remove_contaminated(docs, benchmark).isEmpty()


def test_sums_some_segments_at_a_time_give_the_same(prose, monkeypatch):
    items = [(str(i), prose(600 + i, 30), prose(700 + i, 9)) for i in range(40)]
    index = Index.build(items)
    texts = [plain(f"{prose(i, i * 7)} {items[i][1]} {items[i][2]} {prose(50 + i, 40)}") for i in range(40)]
    whole = index.matches(texts)
    monkeypatch.setattr(decontaminate, "SUMS", 1)
    assert index.matches(texts) == whole


def test_many_items_need_little_memory():
    """Words by blocks as a whole array would take 300 MB here."""
    chance = random.Random(9)
    items = [(str(i), " ".join(f"w{chance.randrange(60_000)}" for _ in range(20)), f"a{i} b{i} c{i}") for i in range(6000)]
    index = Index.build(items)
    held = sum(x.nbytes for x in (index.begins, index.blocks, index.maxima))
    assert len(index.terms) * len(index.needed) * 4 > 200 << 20
    assert held < 4 << 20
    found = index.matches([plain(" ".join(items[i][1:])) for i in range(0, 6000, 500)])
    assert [next(index.names[k] for k in own) for own in found] == [str(i) for i in range(0, 6000, 500)]


def test_empty_tables(docs_of, benchmark, odd_docs):
    assert decontaminate.contaminated(docs_of(), benchmark).collect() == []
    assert decontaminate.contaminated(odd_docs, benchmark.limit(0)).collect() == []
    assert decontaminate.remove_contaminated(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert decontaminate.remove_contaminated(odd_docs, benchmark).columns == odd_docs.columns
