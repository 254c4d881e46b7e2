import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from gatelog.llm import exact_dedup


def by_hand(rows):
    """rows: (doc_id, text) → multiset of the operator's rows."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for plain, members in groups.items():
        members.sort()
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, sha) for i, m in enumerate(members)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


@given(st.binary(max_size=400), st.lists(st.integers(0, 400), max_size=5))
def test_any_way_of_cutting_gives_the_same_fingerprint(data, cuts):
    value, at = 0, 0
    for end in [*sorted(min(c, len(data)) for c in cuts), len(data)]:
        value = exact_dedup.combine(value, exact_dedup.fingerprint(data[at:end]), end - at)
        at = end
    assert value == exact_dedup.fingerprint(data) == int.from_bytes(data, "big") % exact_dedup.PRIME


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(exact_dedup.groups(odd_docs)) == by_hand(rows)


def test_huge_documents_are_sliced_and_collisions_split(docs_of, prose):
    rows = [(i, prose(i % 7, 900) + " " * (i % 3)) for i in range(20)]
    docs = docs_of(*rows)
    assert rows_of(exact_dedup.groups(docs, slice_bytes=500)) == by_hand(rows)
    assert rows_of(exact_dedup.groups(docs, prime=251, slice_bytes=500)) == by_hand(rows)


def test_dedupe_keeps_one_row_with_all_columns(odd_docs):
    kept = exact_dedup.dedupe(odd_docs)
    assert kept.columns == odd_docs.columns
    want = [r for r in by_hand([(r.doc_id, r.text) for r in odd_docs.collect()]) if r[3]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in want), key=repr)


@pytest.mark.parametrize("function", [exact_dedup.groups, exact_dedup.dedupe])
def test_empty_table(docs_of, function):
    assert function(docs_of()).collect() == []


def test_repeated_texts_are_cut_by_one_worker_per_task(spark, docs_of, prose, capsys):
    docs = docs_of(*((i, prose(i % 5, 40)) for i in range(8)), (8, None), (9, None))
    rows = exact_dedup.fingerprints(docs)
    found = exact_dedup.differing(docs, rows)
    capsys.readouterr()
    found.explain()
    assert len(re.findall("MapInArrow|ArrowEvalPython", capsys.readouterr().out)) == 1
    assert found.collect() == []


@given(st.binary(max_size=40))
def test_the_map_is_asked_for_the_bits_that_are_set(data):
    value = exact_dedup.fingerprint(data)
    assert int.from_bytes(exact_dedup._packed(value)[12:16], "big") % exact_dedup.MAP_BITS == value % exact_dedup.MAP_BITS


def test_a_fingerprint_has_its_bit_on_both_sides(spark):
    values = [exact_dedup.fingerprint(bytes([i]) * (i + 1)) for i in range(60)] + [0, exact_dedup.PRIME - 1]
    df = spark.createDataFrame([(exact_dedup._packed(v),) for v in values], "fp binary")
    bits = [r.bit for r in df.select(exact_dedup._bit(df.fp).alias("bit")).collect()]
    assert bits == [v % exact_dedup.MAP_BITS for v in values]
