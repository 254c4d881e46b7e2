import hashlib
from collections import Counter

import numpy as np
import pytest

from gatelog.llm import suffix_dedup


def by_hand(rows, length):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def planted(prose):
    passage, other = prose(50, 60), prose(51, 45)
    rows = [(i, f"{prose(i, 40)} {passage[i : 300 - i]} {prose(100 + i, 30)} {other[: 150 + 20 * i]}") for i in range(12)]
    return [*rows, (20, "Aié " * 400), (21, "x" * 700), (22, passage + passage), (23, prose(7, 2000)), (24, prose(7, 2000)), (25, passage[:199])]


@pytest.mark.parametrize("length", [10, 60, 200, 300])
def test_same_as_all_windows_compared(docs_of, prose, length):
    rows = planted(prose)
    assert rows_of(suffix_dedup.repeated_spans(docs_of(*rows), length=length)) == by_hand(rows, length)


def test_texts_longer_than_a_piece(docs_of, prose, monkeypatch):
    rows = planted(prose)
    monkeypatch.setattr(suffix_dedup, "PIECE", 150)
    found = []
    for data, parts in suffix_dedup.pieces([t.encode() for _, t in rows], 200):
        _, _, part, start, width, _ = suffix_dedup.runs(data, parts, 200)
        found += [(parts[p][0], s + k) for p, s, w in zip(part, start, width, strict=True) for k in range(w)]
    assert sorted(found) == [(i, k) for i, (_, t) in enumerate(rows) for k in range(len(t.encode()) - 199)]


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(suffix_dedup.repeated_spans(odd_docs)) == by_hand(rows, 200)


def test_empty_table(docs_of):
    assert suffix_dedup.repeated_spans(docs_of()).collect() == []
