"""Held-out accuracy of the positive-unlabelled classifier, and its risk and prior on drawn points."""

import numpy as np
from pyspark.sql import functions as F

from survista.llm import quality
from survista.llm.common import read


def points(n, prior, seed):
    r = np.random.default_rng(seed)
    pos = r.normal(1.5, 1, (n, 4))
    y = r.random(n) < prior
    return pos, np.where(y[:, None], r.normal(1.5, 1, (n, 4)), r.normal(-1.5, 1, (n, 4))), y


def prior_by_halves(pos, unl):
    hp, hu = np.arange(len(pos)) % 2, np.arange(len(unl)) % 2
    models = quality.cross_fitted(pos, unl, hp, hu)
    sp, su = quality.judged(models, pos, hp), quality.judged(models, unl, hu)
    cuts = quality.cuts_of(sp)
    return quality.prior_of(quality.above(sp, cuts), len(sp), quality.above(su, cuts), len(su))


def test_prior_and_risk():
    for prior in (0.3, 0.6, 0.9):
        pos, unl, y = points(4000, prior, int(prior * 10))
        got = prior_by_halves(pos, unl)
        assert abs(got - prior) < 0.06
        model = quality.nn_pu(pos, unl, got)
        assert ((model.score(unl) >= 0.5) == y).mean() > 0.97


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = read(spark, sf, "labels")
    out = quality.classify(read(spark, sf, "documents"), labels)
    rows = out.filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
    assert sum(r.predicted for r in rows if r.quality == 1) / sum(r.quality for r in rows) > 0.97


def test_labels_of_held_out_rows_and_negatives_are_not_read(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    held = quality.held_out("doc_id")
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).when(F.col("quality") == 0, 0).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in quality.classify(docs, other.filter("quality = 1 or quality is null")).collect()}


def test_edge_rows(spark, frame):
    rows = [(None, "Good text."), (1, None), (2, ""), (3, "x"), (4, "word " * 60_000), (4, "word " * 60_000), (5, "é" * 10)]
    labels = spark.createDataFrame([(1, 1), (3, None), (4, 1), (4, 0), (99, 1), (None, 1), (5, 1)], "doc_id bigint, quality int")
    for known in (labels, labels.filter("false")):
        got = quality.classify(frame(rows), known).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        kept = quality.keep_good(frame(rows), known)
        assert kept.columns == frame(rows).columns and kept.count() == sum(r.predicted for r in got)
    assert {r.score for r in got} == {0.5}
    assert quality.classify(frame([]), labels).collect() == []


def test_sample_is_that_of_all_ids(spark):
    ids = spark.range(20_000)
    got = sorted(r.id for r in quality._sample(ids, 100, 3).collect())
    every = ids.orderBy(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 62)), "id").limit(100)
    assert got == sorted(r.id for r in every.collect())
    assert quality._sample(ids.limit(5), 100, 3).count() == 5 and quality._sample(ids.limit(0), 100, 3).count() == 0


def test_prior_is_that_of_all_rows(spark, sf):
    """The count over all rows agrees with one made here, whatever the size of the sample."""
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    figures = quality.measured(docs)
    _, prior = quality.learn(figures, labels, sample=60)
    every = figures.orderBy("id").collect()
    assert len(every) > 60
    seen = {}

    def keep(pos, unl, hp, hu):
        seen["models"], seen["pos"] = cross(pos, unl, hp, hu), (pos, hp)
        return seen["models"]
    cross, quality.cross_fitted = quality.cross_fitted, keep
    try:
        assert quality.learn(figures, labels, sample=60)[1] == prior
    finally:
        quality.cross_fitted = cross
    sp = quality.judged(seen["models"], *seen["pos"])
    su = quality.judged(seen["models"], quality._figures([r.x for r in every]), np.array([r.half for r in every]))
    cuts = quality.cuts_of(sp)
    assert abs(quality.prior_of(quality.above(sp, cuts), len(sp), quality.above(su, cuts), len(su)) - prior) < 1e-9


def test_an_id_on_very_many_rows_counts_once(spark, frame):
    rows = [(i, f"Text number {i} is here.") for i in range(40)] + [(7, "the same again and again")] * 20_000
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)] + [(7, 1)], "doc_id bigint, quality int")
    taken = {}
    fit, quality.nn_pu = quality.nn_pu, lambda pos, unl, prior: taken.update(pos=len(pos), unl=len(unl)) or fit(pos, unl, prior)
    try:
        quality.learn(quality.measured(frame(rows)), labels)
    finally:
        quality.nn_pu = fit
    assert taken == {"pos": 21, "unl": 40}
