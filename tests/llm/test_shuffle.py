"""The uniform shuffle: exact sizes, the matrix's law, stable results."""

from collections import Counter
from itertools import permutations
from math import comb

import numpy as np
import pytest

from survista.llm import shuffle
from survista.llm.catalog import QUERIES
from survista.llm.common import read


def test_matrix_has_the_sizes_asked_for():
    for sizes, room in (([5, 0, 9, 1], [4, 4, 4, 3]), ([7], [3, 4]), ([100, 250, 3, 80, 67], [125, 125, 125, 125]), ([0, 2], [1, 1, 0])):
        before = np.concatenate(([0], np.cumsum(sizes)))
        matrix = np.array([shuffle.matrix_row(b, before, np.array(room), 3) for b in range(len(sizes))])
        assert (matrix >= 0).all() and matrix.sum(axis=0).tolist() == room and matrix.sum(axis=1).tolist() == list(sizes)


def test_matrix_law_is_hypergeometric():
    before, room, n = np.array([0, 4, 7, 9]), np.array([3, 3, 3]), 20_000
    seen = Counter(int(shuffle.matrix_row(0, before, room, s)[1]) for s in range(n))
    for k in range(4):
        p = comb(3, k) * comb(6, 4 - k) / comb(9, 4)
        assert abs(seen[k] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-9


def test_far_draws_follow_the_same_law():
    u = (np.arange(20_000) + 0.5) / 20_000
    got = Counter(shuffle.draw_far(x, 30, 70, 20) for x in u)
    for k in range(21):
        assert abs(got[k] / len(u) - comb(30, k) * comb(70, 20 - k) / comb(100, 20)) < 1e-3
    good, bad, n = 6_000_000_000, 94_000_000_000, 10_000_000_000
    sd = (n * 0.06 * 0.94 * 0.9) ** 0.5
    assert abs(shuffle.draw_far(0.5, good, bad, n) - 600_000_000) < 2
    assert abs(shuffle.draw_far(0.841345, good, bad, n) - 600_000_000 - sd) < 0.01 * sd
    assert shuffle.draw(np.random.default_rng(1), np.array([good]), np.array([bad]), np.array([n]))[0] > 599_000_000
    assert shuffle.draw_far(0.3, 5, 0, 3) == 3


def checked(df, shards, n):
    rows = df.collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == n and all(n // shards <= sizes[s] <= n // shards + 1 for s in range(shards))
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    return rows


def test_whole_table_in_small_bins(spark, sf):
    docs = read(spark, sf, "documents")
    n = docs.count()
    rows = checked(shuffle.shuffle_into_shards(docs.repartition(5, "doc_id"), shards=7, bin_rows=9), 7, n)
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert [c for c in rows[0].asDict()] == [*docs.columns, "shard", "slot"]
    again = shuffle.shuffle_into_shards(docs.repartition(5, "doc_id"), shards=7, bin_rows=9).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))  # the same blocks and seed
    other = shuffle.shuffle_into_shards(docs.repartition(5, "doc_id"), shards=7, bin_rows=9, seed=1).collect()
    assert sorted(map(str, rows)) != sorted(map(str, other))


def test_every_order_is_as_likely(spark):
    df = spark.range(4).repartition(2, "id")
    seen = Counter()
    for seed in range(150):
        rows = shuffle.shuffle_into_shards(df, shards=2, seed=seed, bin_rows=1).collect()
        seen[tuple(r["id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])))] += 1
    assert len(seen) >= 22 and set(seen) <= set(permutations(range(4))) and max(seen.values()) < 22


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a")] * 40 + [(None, None)] * 3 + [(2, ""), (3, "x" * 300_000)]])
def test_edge_rows(frame, rows):
    docs = frame(rows).selectExpr("*", "'old' AS Slot", "1 AS block", "2 AS bin")
    out = shuffle.shuffle_into_shards(docs, shards=16)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "block", "bin", "shard", "slot"]
    got = checked(out, 16, len(rows))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(rows, key=str)


def test_query(spark, sf):
    import zlib

    docs = {r["doc_id"]: (r["text"] or "").encode() for r in read(spark, sf, "documents").collect()}
    rows = checked(QUERIES["op11_shards"](spark, sf), 16, len(docs))
    for r in rows:
        t = docs[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t) + 1, zlib.crc32(t), "rows", None)


def test_a_table_without_other_columns(spark):
    out = shuffle.shuffle_into_shards(spark.range(5).selectExpr("id AS shard"), shards=2)
    assert out.columns == ["shard", "slot"] and len(checked(out, 2, 5)) == 5


def test_intermediates_are_deleted_on_request(spark, frame, tmp_path):
    import os

    from survista.llm.common import delete_intermediates, intermediate_paths

    before = intermediate_paths(spark)
    out = shuffle.shuffle_into_shards(frame([(i, "x") for i in range(9)]), shards=2)
    mine = [p for p in intermediate_paths(spark) if p not in before]
    out.write.parquet(str(tmp_path / "out"))
    assert len(mine) == 1 and os.path.isdir(mine[0])
    delete_intermediates(spark, mine)
    assert not os.path.exists(mine[0]) and intermediate_paths(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
