"""Quality classifier learnt from trusted positives and unlabelled text."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise, utf8

#: Kinds of bytes: a-z, A-Z, 0-9, space, other control and white space, marks of prose, other marks, non-ASCII.
_KIND = np.full(256, 7, np.uint8)
_KIND[:128] = 6
_KIND[:33] = 4
_KIND[127] = 4
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), (32,))):
    _KIND[list(_bytes)] = _k
_KIND[list(b".,;:'\"-()?")] = 5
FEATURES = 72


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of pairs of neighbouring byte kinds, and eight figures on words and lines."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    kinds = _KIND[np.frombuffer(text, np.uint8)]
    if len(kinds) > 1:
        out[:64] = np.sqrt(np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64) / (len(kinds) - 1))
    words = text.split()
    if words:
        n = len(words)
        out[64:] = (len(set(words)) / n, np.sqrt(sum(a == b for a, b in pairwise(words)) / n), len(text) / n / 10,
                    np.log1p(n) / 10, text.count(b"\n") / n, len(set(text.lower().split())) / n,
                    np.sqrt(len(set(words))) / 100, 1.0)
    return out


class Model:
    """One hidden layer over standardised features."""

    def __init__(self, mean, scale, w1, b1, w2, b2):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2

    def margin(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x).astype(np.float64), -30, 30)))


def _softplus(z):
    return np.logaddexp(0, z)


def _fit(pos: np.ndarray, unl: np.ndarray, grad_of, epochs: int, seed: int, hidden: int = 32, batch: int = 512) -> Model:
    """Adam on grad_of(margins of positives, of unlabelled) -> gradients of both."""
    r = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (pos - mean) / scale, (unl - mean) / scale
    theta = [r.normal(0, np.sqrt(2 / p.shape[1]), (p.shape[1], hidden)), np.zeros(hidden), r.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta], 0
    steps = max(1, len(u) // batch)
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        for _ in range(steps):
            x = np.concatenate([p[r.integers(0, len(p), batch)], u[r.integers(0, len(u), batch)]])
            a = x @ theta[0] + theta[1]
            h = np.maximum(a, 0)
            z = h @ theta[2] + theta[3]
            g = np.concatenate(grad_of(z[:batch], z[batch:]))
            back = np.outer(g, theta[2]) * (a > 0)
            t += 1
            for i, d in enumerate((x.T @ back, back.sum(0), h.T @ g, g.sum(keepdims=True))):
                d = d + 1e-4 * theta[i]
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                theta[i] = theta[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, *theta[:3], float(theta[3][0]))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def cross_fitted(pos: np.ndarray, unl: np.ndarray, pos_half: np.ndarray, unl_half: np.ndarray, epochs: int = 10, seed: int = 0) -> list[Model]:
    """Classifiers of positive against unlabelled rows: that of place h learned from the half 1 - h and judges the half h."""
    def grad(zp, zu):
        return -_sigmoid(-zp) / len(zp), _sigmoid(zu) / len(zu)

    def half(x, marks, h):
        return x[marks != h] if (marks != h).any() else x

    return [_fit(half(pos, pos_half, h), half(unl, unl_half, h), grad, epochs, seed) for h in (0, 1)]


def judged(models: list[Model], x: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Margins of rows by the classifier that did not learn from their half."""
    return np.where(half == 0, models[0].margin(x), models[1].margin(x))


def cuts_of(margins: np.ndarray) -> np.ndarray:
    """Thresholds: quantiles of the positives' margins."""
    return np.quantile(margins, np.linspace(0, 0.95, 96))


def above(margins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Rows at or above each threshold."""
    return len(margins) - np.searchsorted(np.sort(margins), cuts, side="left")


def prior_of(pos_above: np.ndarray, n_pos: int, unl_above: np.ndarray, n_unl: int) -> float:
    """Share of positives in the unlabelled rows: the smallest ratio of the shares above a threshold, unlabelled to positive,
    with a margin for chance that keeps thresholds with few rows out (the best bin)."""
    qp, qu = pos_above / n_pos, unl_above / n_unl
    slack = np.sqrt(np.log(40) / 2 / n_pos) + np.sqrt(np.log(40) / 2 / n_unl)
    best = int(((qu + slack) / qp).argmin())
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def nn_pu(pos: np.ndarray, unl: np.ndarray, prior: float, epochs: int = 40, seed: int = 0) -> Model:
    """Minimise the non-negative unbiased risk prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)) under
    the logistic loss. Where the negative part falls below zero, the step goes back up it instead."""
    def grad(zp, zu):
        negative = _softplus(zu).mean() - prior * _softplus(zp).mean()
        gp, gu = -prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
        if negative < 0:
            return -gp, -gu
        return -prior * _sigmoid(-zp) / len(zp) + gp, gu

    return _fit(pos, unl, grad, epochs, seed)


def _sample(ids: DataFrame, n: int, salt: int) -> DataFrame:
    """At most n of the ids, those with the smallest hashes. Hashes far above where the n-th must lie are left out before
    the sort, so that each task sends about its share of the sample and not n rows."""
    key, span = F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1 << 62)), 1 << 62
    bound = span * 4 * n // max(1, ids.count())
    near = ids.filter(key < F.lit(bound)) if bound < span else ids
    return near.orderBy(key, "id").limit(n)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, half, x) for each row: the text's figures, and which half of the rows its id puts it in; written once."""
    spec = docs.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(2)).cast("int").alias("half"),
                       F.col(text_col).cast("string").alias("text"))

    def measure(batches):
        for b in batches:
            x = [features(t).tobytes() for t in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("half"), pa.array(x, pa.binary())], ["id", "half", "x"])

    return materialise(spec.mapInArrow(measure, f"id {spec.schema['id'].dataType.simpleString()}, half int, x binary"), "quality")


def _figures(x: list) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, x)), np.float32).reshape(-1, FEATURES).astype(np.float64)


def learn(figures: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          sample: int = 10_000) -> tuple[Model, float] | None:
    """Model and class prior, from rows of ``measured``. Gradient steps take at most ``sample`` trusted positives (ids whose
    every label is 1) and draw their unlabelled rows from as many ids, picked by hash; negative labels are not used. The
    class prior is that of all rows: each is judged by one of two cross-fitted classifiers, and what lies above each threshold
    is counted in Spark. None without two positives. The sample's figures (72 numbers an id, one row of each) go to the
    driver, texts do not."""
    trusted = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
               .agg(F.min(label_col).alias("least"), F.max(label_col).alias("most")).filter("least = 1 and most = 1").select("id"))
    there = figures.select("id").filter("id is not null").distinct()
    picks = (_sample(trusted.join(there, "id", "left_semi"), sample, 1).select("id", F.lit(True).alias("positive"))
             .union(_sample(there, sample, 2).select("id", F.lit(False).alias("positive"))))
    roles = picks.groupBy("id").agg(F.collect_list("positive").alias("roles"))
    got = figures.join(F.broadcast(roles), "id").groupBy("id").agg(F.min("half").alias("half"), F.min("x").alias("x"), F.first("roles").alias("roles")).collect()
    got.sort(key=lambda r: r.id)
    pos, unl = ([r for r in got if role in r.roles] for role in (True, False))
    if len(pos) < 2 or len(unl) < 2:
        return None
    pos_half, unl_half = (np.array([r.half for r in rows]) for rows in (pos, unl))
    pos, unl = (_figures([r.x for r in rows]) for rows in (pos, unl))
    models = cross_fitted(pos, unl, pos_half, unl_half)
    margins = judged(models, pos, pos_half)
    cuts = cuts_of(margins)
    shared = figures.sparkSession.sparkContext.broadcast((models, cuts))

    def count(batches):
        models, cuts = shared.value
        total, rows = np.zeros(len(cuts), np.int64), 0
        for b in batches:
            x, half = _figures(b.column("x").to_pylist()), b.column("half").to_numpy()
            total += above(judged(models, x, half), cuts)
            rows += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(cuts)), -1]), pa.array([*total.tolist(), rows])], ["cut", "n"])

    counted = figures.select("half", "x").mapInArrow(count, "cut bigint, n bigint").groupBy("cut").agg(F.sum("n").alias("n"))
    n = {r.cut: r.n for r in counted.collect()}  # one number a threshold
    prior = prior_of(above(margins, cuts), len(pos), np.array([n[k] for k in range(len(cuts))]), n[-1])
    return nn_pu(pos, unl, prior), prior


def scores(figures: DataFrame, model: Model | None) -> DataFrame:
    """(id, score) for each row of ``measured``; 0.5 without a model."""
    def scored(batches):
        for b in batches:
            x = _figures(b.column("x").to_pylist())
            s = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s, pa.float64())], ["id", "score"])

    return figures.select("id", "x").mapInArrow(scored, f"id {figures.schema['id'].dataType.simpleString()}, score double")


def held_out(id_col: str, folds: int = 5):
    """Whether crc32 of the id as text leaves remainder 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             threshold: float = 0.3, folds: int = 5, sample: int = 10_000) -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, score, predicted.

    Learns from rows that are not held out; a score reads the text alone. Null and empty texts have the score of a
    text without features. Labels that are null, or of rows that are not there, or that contradict each other are not
    used. Without a positive label every score is 0.5. Repeated rows give repeated result rows; an empty table none.
    """
    figures = measured(docs, id_col, text_col)
    fitted = learn(figures.filter(~held_out("id", folds)), labels.filter(~held_out(id_col, folds)), id_col, label_col, sample)
    out = scores(figures, fitted and fitted[0]).withColumnRenamed("id", id_col)
    return out.select(id_col, held_out(id_col, folds).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
              threshold: float = 0.3, folds: int = 5, sample: int = 10_000) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns. A row is judged by its own text, so
    rows with null or repeated ids are too."""
    figures = measured(docs.filter(~held_out(id_col, folds)), id_col, text_col)
    fitted = learn(figures, labels.filter(~held_out(id_col, folds)), id_col, label_col, sample)
    model, at = fitted and fitted[0], docs.columns.index(text_col)

    def good(batches):
        for b in batches:
            x = np.array([features(t) for t in utf8(b.column(at))]).reshape(-1, FEATURES)
            yield b.filter(pa.array((model.score(x) if model else np.full(len(x), 0.5)) >= threshold))

    return docs.mapInArrow(good, docs.schema)
