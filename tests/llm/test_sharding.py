import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from gatelog.llm import sharding


@given(st.integers(2, 6), st.data())
def test_quotas_keep_every_size(shards, data):
    numbers = st.lists(st.integers(0, 20), min_size=shards * shards, max_size=shards * shards)
    wanted = np.array(data.draw(numbers)).reshape(shards, shards)
    free = np.array(data.draw(st.lists(st.integers(0, 20), min_size=shards, max_size=shards)))
    allowed, fill = sharding.quotas(wanted, free)
    moves = allowed + fill
    assert (moves.sum(axis=0) == moves.sum(axis=1)).all()
    off = wanted * (1 - np.eye(shards, dtype=int))
    assert (allowed >= 0).all() and (allowed <= off).all() and (fill.sum(axis=1) <= free).all()


def check(rows, shards):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min([*sizes.values(), *([0] if len(sizes) < shards else [])]) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_linked_documents_share_a_shard(docs_of, prose):
    rows = [(i, prose(i % 90, 20)) for i in range(150)] + [(1000 + i, prose(1000 + i, 20)) for i in range(150)]
    got = sharding.shard_documents(docs_of(*rows), shards=8).collect()
    check(got, 8)
    texts = dict(rows)
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    homes = defaultdict(set)
    for r in got:
        homes[r.text_key].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_a_hub_of_half_of_all_rows(docs_of, prose):
    """It fills whole shards instead of being spread over all."""
    rows = [(i, "same") for i in range(200)] + [(1000 + i, prose(i, 20)) for i in range(200)]
    got = sharding.shard_documents(docs_of(*rows), shards=8).collect()
    check(got, 8)
    together = Counter(r.shard for r in got if r.doc_id < 200)
    assert sum(n == 50 for n in together.values()) >= 3


def test_a_table_where_every_row_has_a_copy(docs_of, prose):
    """No document is free to fill gaps; shards swap linked ones."""
    rows = [(i, prose(i // 2, 20)) for i in range(960)]
    got = sharding.shard_documents(docs_of(*rows), shards=8).collect()
    check(got, 8)
    homes = defaultdict(set)
    for r in got:
        homes[r.text_key].add(r.shard)
    split = sum(len(h) > 1 for h in homes.values())
    print(f"{split} of {len(homes)} pairs are split")
    assert split <= 14  # a pair for each of the 8 shards' borders may be left, after one round it is dozens


def test_odd_rows(odd_docs):
    got = sharding.shard_documents(odd_docs).collect()
    check(got, sharding.SHARDS)
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd_docs.collect())
    assert all(r.size == 8 for r in got if r.doc_id in (4, 5))


def test_same_shards_for_any_order_of_rows(docs_of, prose):
    rows = [(i, prose(i % 20, 10)) for i in range(60)]
    one = {r.doc_id: r.shard for r in sharding.shard_documents(docs_of(*rows)).collect()}
    two = {r.doc_id: r.shard for r in sharding.shard_documents(docs_of(*rows[::-1], partitions=5)).collect()}
    assert one == two


@pytest.mark.parametrize("shards", [1, 24])
def test_empty_table(docs_of, shards):
    assert sharding.shard_documents(docs_of(), shards=shards).collect() == []
