"""SimHash against a brute-force version: per-bit counts in Python and all pairs on small tables."""

import re

import pytest
import xxhash

from survista.llm import simhash
from survista.llm.common import read


def brute_print(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << i for i in range(64) if sum(x >> i & 1 for x in h) * 2 > len(h))


def brute(rows, radius=2):
    """rows: (id, fingerprint). Ids to the smallest id reachable."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(k)
    return [(k, min((x for x in groups[root(i)] if x is not None), default=None)) for i, (k, _) in enumerate(rows)]


def got(df):
    return sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in df.collect()), key=str)


def expected(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    return sorted(((i, f, c) for (i, f), (_, c) in zip(prints, brute(prints), strict=True)), key=str)


def test_masks_cover():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_whole_table(spark, sf):
    docs = read(spark, sf, "documents")
    assert got(simhash.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(frame):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, None), (8, ""), (9, " \t\n"), (10, "One"), (11, "ONE  "),
            (12, "One two"), (None, "lonely words here"), (14, "É é É"), (15, "x " * 70000)]
    assert got(simhash.near_duplicates(frame(rows))) == expected(rows)


def test_empty_table(frame):
    assert got(simhash.near_duplicates(frame([]))) == []


@pytest.mark.parametrize("radius,bucket", [(1, 64), (2, 64), (2, 1), (1, 1), (3, 1), (3, 64)])
def test_links_have_the_components_of_all_pairs(spark, radius, bucket):
    import random
    r = random.Random(radius)
    fps = set()
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for b in r.sample(range(64), r.choice([1, 1, 2, 3])):
                x ^= 1 << b
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    found = simhash.links(df, radius, bucket)
    for u, v in found.collect():
        assert ((u ^ v) & (2**64 - 1)).bit_count() <= radius
    label = {x.node: x.label for x in simhash.connected_components(found).collect()}
    want = dict(brute([(f, f & (2**64 - 1)) for f in fps], radius))
    assert {f: label.get(f, f) for f in fps} == want


def test_keep_one_keeps_columns_and_one_of_each_group(frame):
    rows = [(3, "same text of words"), (1, "same text of words"), (2, "another one entirely, quite different"), (None, None)]
    out = simhash.keep_one(frame(rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "None"]


def test_keep_one_by_row_where_ids_are_null_or_repeated(frame):
    a, b, c = "same text of words", "another one entirely, quite different", "a third text that has nothing of the others"
    rows = [(None, a), (5, a), (None, b), (None, b), (7, c), (7, c), (5, c)]
    out = simhash.keep_one(frame(rows)).select("doc_id", "text").collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([(5, a), (None, b), (5, c)], key=str)
