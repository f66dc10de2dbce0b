"""Hard negatives by exact integer scores, with angular triangle filtering.

Every row is stored with its angles to a few reference directions. The angle between two vectors is at least the
difference and at most the sum of their angles to any direction, so stored angles give an interval of their cosine and,
times the norms, one of their score. Rows stand sorted by nearest reference and angle; a window is a run of them, with
the least and greatest angle and norm. An anchor scores the rows of those windows whose score interval, rounded
outward, meets the scores it looks for; no other pair is touched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from survista.llm.common import materialise

#: Stored angles are 32-bit; what they and the arc cosine may be wrong by, in radians.
_ANGLE_ERROR = 4e-6
#: Rounded components beyond this are taken as this, so that sums fit 64 bits.
_MOST = 1 << 24
#: Hits that are held before the best are picked.
_HELD = 1 << 18
#: Stands for a null id: ties leave it last.
_NO_ID = (1 << 63) - 1
_NEVER = 1 << 62


@dataclass
class Rows:
    """Vectors with what belongs to them; arrays of one length."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray  # of str
    q: np.ndarray  # rounded components
    norm: np.ndarray
    angles: np.ndarray  # to each reference

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, dims: int) -> Rows:
        def packed(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1)

        def flat(name: str) -> np.ndarray:
            return batch.column(name).to_numpy() if isinstance(batch, pa.Table) else batch.column(name).to_numpy(zero_copy_only=False)

        q = packed("q", np.int32) if dims else np.zeros((batch.num_rows, 0), np.int32)
        return cls(flat("row"), flat("id"), np.array(batch.column("label").to_pylist(), object), q, flat("norm"), packed("angles", np.float32))

    def cut(self, a: int, z: int) -> Rows:
        return Rows(self.row[a:z], self.id[a:z], self.label[a:z], self.q[a:z], self.norm[a:z], self.angles[a:z])


def rounded(vectors: list, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, short vectors filled with zeros."""
    out = np.zeros((len(vectors), dims), np.int32)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.clip(np.floor(scale * np.asarray(v, np.float64)), -_MOST, _MOST)
    return out


def angles_to(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of vectors to unit references; a zero vector, whose score is always zero, gets any."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = (q @ references.T) / norm[:, None]
    return np.arccos(np.clip(np.nan_to_num(cosine), -1.0, 1.0)).astype(np.float32)


def spread(q: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` unit references among sample vectors, each far from those before it."""
    norm = np.linalg.norm(q.astype(np.float64), axis=1)
    unit = q[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.zeros((1, q.shape[1]))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, unit @ unit[far])
    return unit[chosen]


def score_interval(anchors: Rows, window: Rows) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the least and greatest score that any row of the window can have, rounded outward."""
    a = anchors.angles.astype(np.float64)
    low, high = window.angles.min(axis=0).astype(np.float64), window.angles.max(axis=0).astype(np.float64)
    least = np.maximum(np.maximum(a - high, low - a).max(axis=1) - _ANGLE_ERROR, 0.0)
    most = np.minimum(np.minimum(a + high, 2 * np.pi - a - low).min(axis=1) + _ANGLE_ERROR, np.pi)
    small, large = window.norm.min(), window.norm.max()
    top, bottom = np.cos(least), np.cos(np.maximum(least, most))
    top = anchors.norm * np.where(top > 0, top * large, top * small)
    bottom = anchors.norm * np.where(bottom > 0, bottom * small, bottom * large)
    slack = 1 + anchors.norm * large * 1e-12
    return np.floor(bottom - slack), np.ceil(top + slack)


def integer_scores(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products: in floats as long as no sum can leave their integers (``bound``: product of the norms)."""
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """For each anchor and each of its score ranges the first ``k`` rows: higher scores first, then smaller ids."""

    def __init__(self, anchors: Rows, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.anchors, self.low, self.high, self.k, self.same = anchors, low.copy(), high, k, same
        self.last = np.full(low.shape, _NO_ID)  # id of the k-th, where there are k
        self.kept = [np.empty((4, 0), np.int64) for _ in range(low.shape[1])]
        self.held: list[np.ndarray] = []
        self.n_held = 0
        names = {x: i for i, x in enumerate(dict.fromkeys(anchors.label.tolist()))}
        self.names, self.code = names, np.array([names[x] for x in anchors.label.tolist()], np.int64)

    def offer(self, window: Rows) -> None:
        bottom, top = score_interval(self.anchors, window)
        low, high = self.low.min(axis=1), self.high.max(axis=1)
        at = np.flatnonzero((top >= low) & (bottom <= high))
        if not len(at):
            return
        bound = float(self.anchors.norm[at].max() * window.norm.max())
        s = integer_scores(self.anchors.q[at], window.q, bound)
        code = np.array([self.names.get(x, -1) for x in window.label.tolist()], np.int64)
        fits = (self.code[at][:, None] == code[None, :]) == self.same
        if self.same:
            fits &= self.anchors.row[at][:, None] != window.row[None, :]
        i, j = np.nonzero(fits & (s >= low[at][:, None]) & (s <= high[at][:, None]))
        hit = np.stack((at[i], window.row[j], window.id[j], s[i, j]))
        self.held.append(hit[:, self._wanted(hit).any(axis=0)])
        self.n_held += self.held[-1].shape[1]
        if self.n_held > _HELD:
            self.pick()

    def _wanted(self, hit: np.ndarray) -> np.ndarray:
        """Ranges by hits: those that a hit can still be among the first of."""
        a, score = hit[0], hit[3]
        low, high, last = self.low[a].T, self.high[a].T, self.last[a].T
        return (score <= high) & ((score > low) | (score == low) & (hit[2] <= last))

    def pick(self) -> None:
        new = np.concatenate([np.empty((4, 0), np.int64), *self.held], axis=1)
        wanted = self._wanted(new)
        for r, kept in enumerate(self.kept):
            hit = np.concatenate((kept, new[:, wanted[r]]), axis=1)
            hit = hit[:, np.lexsort((hit[1], hit[2], -hit[3], hit[0]))]
            first = np.searchsorted(hit[0], hit[0])
            rank = np.arange(hit.shape[1]) - first
            full = rank == self.k - 1
            self.low[hit[0][full], r], self.last[hit[0][full], r] = hit[3][full], hit[2][full]
            self.kept[r] = hit[:, rank < self.k]
        self.held, self.n_held = [], 0

    def forget(self) -> None:
        """Drops the hits but not what they say of the k-th score."""
        self.pick()
        self.kept = [x[:, :0] for x in self.kept]


def valid(vector: Column) -> Column:
    """The vector and all its components are there and finite."""
    x = vector.cast("array<double>")
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def stored_rows(table: DataFrame, anchor: Column, id_col: str, label_col: str, vector_col: str, scale: int, references: int,
                sample: int) -> tuple[DataFrame, Rows | None, int]:
    """The valid rows with rounded vector, norm and angles, written sorted by nearest reference and angle; a bounded sample
    of them; and the length of the vectors."""
    rows = materialise(
        table.filter(valid(F.col(vector_col)) & F.col(label_col).isNotNull())
        .select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(label_col).cast("string").alias("label"),
                F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
                F.monotonically_increasing_id().alias("row")), "negatives-rows")
    n, dims = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return rows, None, 0
    picked = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("row", "id", "label", "vector").collect()
    q = rounded([r["vector"] for r in picked], dims, scale)
    directions = spread(q, references)

    def measured(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norm = np.sqrt(np.square(q.astype(np.float64)).sum(axis=1))
        return norm, angles_to(q, norm, directions)

    norm, angles = measured(q)
    seen = Rows(np.array([r["row"] for r in picked]), np.array([r["id"] for r in picked]),
                np.array([r["label"] for r in picked], object), q, norm, angles)

    def measure(batches):
        for b in batches:
            q = rounded(b.column("vector").to_pylist(), dims, scale)
            norm, angles = measured(q)
            home = angles.argmin(axis=1)
            near = angles[np.arange(len(q)), home]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("id"), b.column("label"), b.column("anchor"), pa.array([x.tobytes() for x in q], pa.binary()),
                 pa.array(norm), pa.array([x.tobytes() for x in angles], pa.binary()), pa.array(home.astype(np.int32)), pa.array(near)],
                ["row", "id", "label", "anchor", "q", "norm", "angles", "home", "near"])

    # A task's work is its rows times the anchors: more tasks than rows alone would call for.
    tasks = max(1, min(-(-n // 2048), max(-(-n // 200_000), 2 * table.sparkSession.sparkContext.defaultParallelism)))
    order = ["home", "near", "id", "row"]
    shaped = rows.mapInArrow(measure, "row bigint, id bigint, label string, anchor boolean, q binary, norm double, angles binary, "
                                      "home int, near float")
    return materialise(shaped.repartitionByRange(tasks, *order).sortWithinPartitions(*order), "negatives-stored"), seen, dims


def first_rows(stored: DataFrame, anchors: Rows, sample: Rows, dims: int, low: np.ndarray, high: np.ndarray, k: int, same: bool,
               window: int) -> DataFrame:
    """(anchor, range, rank, id, score): the first ``k`` rows of ``stored`` with the anchor's label (``same``), the anchor itself not
    among them, or with another one, in each of its score ranges. ``anchor`` is a place in ``anchors``.

    The sample's scores set what a row must reach from the start. A task gives at most k rows an anchor and range.
    """
    shared = stored.sparkSession.sparkContext.broadcast((anchors, sample, low, high))

    def scan(batches):
        anchors, sample, low, high = shared.value
        best = None
        for b in batches:
            if best is None:
                best = Best(anchors, low, high, k, same)
                for i in range(0, len(sample.row), window):
                    best.offer(sample.cut(i, i + window))
                best.forget()
            rows = Rows.of(b, dims)
            for i in range(0, len(rows.row), window):
                best.offer(rows.cut(i, i + window))
        if best is not None:
            best.pick()
            for r, hit in enumerate(best.kept):
                if hit.shape[1]:
                    yield pa.RecordBatch.from_arrays([pa.array(hit[0]), pa.array(np.full(hit.shape[1], r)), *map(pa.array, hit[1:])],
                                                     ["anchor", "range", "row", "id", "score"])

    spec = stored.select("row", "id", "label", "q", "norm", "angles")
    hits = spec.mapInArrow(scan, "anchor bigint, range bigint, row bigint, id bigint, score bigint")
    order = Window.partitionBy("anchor", "range").orderBy(F.desc("score"), "id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("anchor", "range", "rank", "id", "score")


def hard_negatives(table: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: int = 256, references: int = 16,
                   sample: int = 2048, anchors_per_pass: int = 16_384, window: int = 256) -> DataFrame:
    """For each anchor row and each of its first ``positives`` other rows of the same label, the first ``negatives`` rows of another
    label with least * positive_score <= 100 * negative_score <= most * positive_score (all, where there are fewer): anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of the components floor(scale * x) (cut to 2**24 in size); higher ones come first, ties by
    smaller id, null ids last and then any. Rows with a null label or vector, or a null or non-finite component, take no
    part; a shorter vector counts as filled with zeros. Ids are integers. Each row is a row of its own: repeated rows are each other's positives,
    and a repeated anchor gives its rows again. Other columns are not read. An empty table, one without anchors, and
    anchors without positives give no rows.

    The sample (``sample`` rows by hash) only serves to choose references and to bound the k-th score from below. Anchors
    are taken ``anchors_per_pass`` at a time; what is broadcast is bounded by these numbers and the vectors' length.
    """
    spark = table.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    stored, seen, dims = stored_rows(table, anchor, id_col, label_col, vector_col, scale, references, sample)
    if seen is None:
        return spark.createDataFrame([], schema)
    asking = stored.filter("anchor").select("row", "id", "label", "q", "norm", "angles")
    passes = -(-asking.count() // anchors_per_pass)
    parts = []
    for p in range(passes):
        chosen = Rows.of(asking.filter(F.pmod(F.xxhash64("row"), F.lit(passes)) == p).toArrow(), dims)
        n = len(chosen.row)
        if not n:
            continue
        whole = np.full((n, 1), _NEVER, np.int64)
        near = first_rows(stored, chosen, seen, dims, -whole, whole, positives, True, window)
        low, high = np.full((n, positives), _NEVER, np.int64), np.full((n, positives), -_NEVER, np.int64)  # nothing fits
        found = near.select("anchor", "rank", "id", "score").collect()  # at most ``positives`` rows an anchor of this pass
        for r in found:
            low[r["anchor"], r["rank"] - 1] = -(-least * r["score"] // 100)
            high[r["anchor"], r["rank"] - 1] = most * r["score"] // 100
        far = first_rows(stored, chosen, seen, dims, low, high, negatives, False, window)
        known = spark.createDataFrame([(r["anchor"], r["rank"] - 1, int(chosen.id[r["anchor"]]), r["id"], r["score"]) for r in found],
                                      "anchor bigint, range bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        joined = far.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(known, ["anchor", "range"])
        real = [F.when(F.col(c) != _NO_ID, F.col(c)).alias(c) for c in ("anchor_id", "positive_id", "negative_id")]
        parts.append(materialise(joined.select(real[0], real[1], "rank", real[2], "positive_score", "negative_score"), "negatives"))
    out = spark.createDataFrame([], schema)
    for part in parts:
        out = out.union(part)
    return out
