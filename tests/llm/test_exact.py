"""Exact duplicates and the counting quotient filter."""

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from survista.llm import exact
from survista.llm.common import read


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 2**60 - 1) | st.integers(0, 40), max_size=60), max_size=5), st.integers(60, 64))
def test_filters_merge_without_loss(parts, width):
    filters = []
    for p in parts:
        v, c = np.unique(np.array(p, np.uint64), return_counts=True)
        filters.append(exact.CountingQuotientFilter.load(exact.CountingQuotientFilter.of(v, c, width).dump()))
    if filters:
        v, c = exact.merged(filters, width).items(width)
        assert dict(zip(v.tolist(), c.tolist(), strict=True)) == Counter(x for p in parts for x in p)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        keep = max((x for x in groups[t or ""] if x is not None), default=None)
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_whole_table(spark, sf):
    docs = read(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(exact.exact_duplicates(docs)) == brute(rows)
    assert got(exact.exact_duplicates(docs, shard_rows=10)) == brute(rows)


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (None, ""), (None, "alone"), (3, "x" * 300_000), (4, "x" * 300_000), (4, "x" * 300_000),
            (5, "a"), (6, "A"), (7, "a "), (8, "é"), (9, "é")]
    assert got(exact.exact_duplicates(frame(rows))) == brute(rows)
    assert got(exact.exact_duplicates(frame([]))) == []
