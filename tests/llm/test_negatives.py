"""Hard negatives against a plain version."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from survista.llm import negatives
from survista.llm.catalog import QUERIES
from survista.llm.common import read

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, anchors=100):
    ok = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(256 * float(x)) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    rank = lambda s, i: (-s, i is None, i or 0)
    out = []
    for n, (a, av, al) in enumerate(ok):
        if a is None or a % anchors:
            continue
        scored = sorted(((sum(x * y for x, y in zip(av, v)), i, label, m) for m, (i, v, label) in enumerate(ok)),  # noqa: B905
                        key=lambda r: rank(r[0], r[1]))
        for ps, p, _, _ in [r for r in scored if r[2] == al and r[3] != n][:5]:
            fit = [r for r in scored if r[2] != al and 80 * ps <= 100 * r[0] <= 100 * ps][:5]
            out += [(a, p, k + 1, i, ps, s) for k, (s, i, _, _) in enumerate(fit)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def mined(df, **sizes):
    from pyspark.sql import functions as F

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(df.withColumn("label", label), F.col("vec_id") % 100 == 0, **sizes)


def test_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, sf, "embeddings").collect()]
    want = brute(rows)
    assert want and got(QUERIES["op12_hard_negatives"](spark, sf)) == want


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(6, 8))
    v = (centre[rng.integers(0, 6, 1500)] + 0.05 * rng.normal(size=(1500, 8))).astype(np.float32)
    v[200:900] = v[200]  # copies: ties by id alone
    v[900:950] *= 40
    rows = [(int(i), [float(x) for x in v[i]], int(label)) for i, label in enumerate(rng.integers(0, 4, 1500))]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(6)


def test_clusters_copies_and_passes(clustered):
    rows, df = clustered
    want = brute(rows)
    assert len(want) > 100
    for sizes in ({}, {"anchors_per_pass": 4, "sample": 64, "window": 16, "references": 3}, {"sample": 1, "references": 1, "window": 7}):
        assert got(mined(df, **sizes)) == want


def test_windows_leave_pairs_untouched(clustered, monkeypatch):
    """Clustered rows: most windows' intervals miss what an anchor looks for."""
    rows, _ = clustered
    rows = rows[:200] + rows[950:]
    q = negatives.rounded([r[1] for r in rows], 8, 256)
    norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
    angles = negatives.angles_to(q, norm, negatives.spread(q, 8))
    order = np.lexsort((angles.min(axis=1), angles.argmin(axis=1)))
    n = len(rows)
    all_rows = negatives.Rows(np.arange(n)[order], np.arange(n)[order], np.array(["a"] * n, object), q[order], norm[order], angles[order])
    best = negatives.Best(all_rows.cut(0, 40), np.full((40, 1), -1 << 62), np.full((40, 1), 1 << 62), 5, True)
    scored = []
    inner = negatives.integer_scores
    monkeypatch.setattr(negatives, "integer_scores", lambda a, b, bound: scored.append(len(a) * len(b)) or inner(a, b, bound))
    for i in range(0, n, 16):
        best.offer(all_rows.cut(i, i + 16))
        best.pick()
    assert sum(scored) < 0.6 * 40 * n


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [1.0, 2.0, 3.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1),
            (4, [inf, 1.0], 1), (5, [1.0, 2.0], None), (None, [1.0, 2.0], 1), (None, [1.0, 1.9], 2), (6, [1.0, 1.9], 2), (7, [1.0, 1.9], 1),
            (8, [0.0, 0.0], 3), (200, [0.0, 0.0], 3), (300, [-1.0, 0.5], 4), (9, [1.0, -5.0], 4), (10, [], 5), (400, [9.0, 9.0], 8),
            (11, [30000.0, 1.0], 1), (12, [29000.0, 1.0], 2)] + [(6, [1.0, 1.9], 2)] * 6
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(mined(df.selectExpr("*", "1 AS row", "2 AS id", "true AS anchor", "3 AS score"))) == brute(rows)
    assert got(mined(df.limit(0))) == []
    assert got(mined(df.filter("vec_id % 100 != 0"))) == []
    assert got(mined(df.filter("size(embedding) = 0 OR vec_id = 400"))) == []


@settings(deadline=None, max_examples=80)
@given(st.integers(0, 10**6), st.floats(0.01, 3), st.integers(1, 6))
def test_intervals_hold_every_score(seed, width, dims):
    rng = np.random.default_rng(seed)
    q = negatives.rounded(list(rng.normal(size=(1, dims)) + width * rng.normal(size=(30, dims))), dims, 256)
    q[3], q[4] = 0, -q[5]
    norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
    angles = negatives.angles_to(q, norm, negatives.spread(q, 4))
    r = negatives.Rows(np.arange(30), np.arange(30), np.array(["a"] * 30, object), q, norm, angles)
    for i in range(5, 30, 5):
        low, high = negatives.score_interval(r, r.cut(i, i + 5))
        s = q.astype(np.int64) @ q[i:i + 5].astype(np.int64).T
        assert (low <= s.min(axis=1)).all() and (high >= s.max(axis=1)).all()


def test_integer_scores_in_each_range():
    rng = np.random.default_rng(3)
    for size in (100, 1 << 20, 1 << 24):
        a = rng.integers(-size, size, (4, 50)).astype(np.int32)
        b = rng.integers(-size, size, (6, 50)).astype(np.int32)
        bound = float(np.linalg.norm(a.astype(float), axis=1).max() * np.linalg.norm(b.astype(float), axis=1).max())
        assert (negatives.integer_scores(a, b, bound) == a.astype(object) @ b.astype(object).T).all()
