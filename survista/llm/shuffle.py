"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows stand in blocks (the tasks that wrote them) and go to bins, contiguous slots of a shard. The matrix says how many
rows of a block go to each bin; its rows sum to the blocks' sizes and its columns to the bins'. In a uniform shuffle
it has a multivariate hypergeometric law, which splits along a tree over the blocks: at a node the left half's rows
are a draw without replacement from what the node's bins still hold. Each node has a seed of its own, so a task draws
its block's matrix row by walking down from the root, and tasks that share a node agree without speaking. Inside a
block the bins' labels are permuted, the rows are exchanged by bin, and a bin's rows are permuted again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from survista.llm.common import materialise

#: numpy draws below this population; beyond it a draw inverts its distribution in a window around the mode.
_NUMPY = 1_000_000_000
#: Half the window in standard deviations: what lies outside has a probability below 1e-30.
_SPREAD = 12


def draw_far(u: float, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw by inversion of the uniform number ``u``; for populations of any size. Probabilities come
    from ratios of neighbours, so only the window's width, some standard deviations, costs time and memory."""
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mean = n * (good / total)
    sd = (mean * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    a, z = max(low, int(mean - _SPREAD * sd) - 50), min(high, int(mean + _SPREAD * sd) + 50)
    k = np.arange(a, z, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate(([0.0], np.cumsum(steps)))
    mass = np.cumsum(np.exp(weight - weight.max()))
    return a + int(np.searchsorted(mass, u * mass[-1], side="right").clip(0, len(mass) - 1))


def draw(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many of ``n`` rows taken without replacement are good, element by element."""
    near = good + bad < _NUMPY
    out = rng.hypergeometric(np.where(near, good, 0), np.where(near, bad, 0), np.where(near, n, 0))
    for i in np.flatnonzero(~near):
        out[i] = draw_far(rng.random(), int(good[i]), int(bad[i]), int(n[i]))
    return out


def draw_many(rng: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows taken without replacement from bins that hold ``room``: rows by bin. Halves of the bins are drawn
    first, then halves of these."""
    sums = [np.append(room, np.zeros((1 << max(0, len(room) - 1).bit_length()) - len(room), np.int64))]
    while len(sums[-1]) > 1:
        sums.append(sums[-1].reshape(-1, 2).sum(axis=1))
    taken = np.array([n], np.int64)
    for s in reversed(sums[:-1]):
        left = draw(rng, s[::2], s[1::2], taken)
        taken = np.column_stack((left, taken - left)).ravel()
    return taken[:len(room)]


def matrix_row(block: int, before: np.ndarray, room: np.ndarray, seed: int) -> np.ndarray:
    """The rows that ``block`` sends to each bin. ``before``: rows before each block, and of all at the end."""
    a, z = 0, len(before) - 1
    while z - a > 1:
        mid = (a + z) // 2
        left = draw_many(np.random.default_rng([seed, a, z]), room, int(before[mid] - before[a]))
        a, z, room = (a, mid, left) if block < mid else (mid, z, room - left)
    return room


def bin_sizes(total: int, shards: int, bins: int) -> np.ndarray:
    """Sizes of ``bins`` bins for each shard; shards, and the bins of a shard, differ by one row at most."""
    shard = total // shards + (np.arange(shards) < total % shards)
    return (shard[:, None] // bins + (np.arange(bins)[None, :] < shard[:, None] % bins)).ravel().astype(np.int64)


def shuffle_into_shards(df: DataFrame, shards: int = 16, seed: int = 42, bin_rows: int = 10_000) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard): one of
    all orders, each as likely as another, cut into shards whose sizes differ by one row at most.

    Every row is a row of its own: nulls, empty and long texts and repeated rows are dealt like any other, and columns of
    ``df`` named shard or slot are replaced. An empty table gives no rows. The rows are first written to the shared folder
    with the number of their block and their place in it. All that follows is a function of the seed and these two
    numbers, so a task that runs again deals its rows as before.

    A bin holds at most ``bin_rows`` rows, more or less, and is what one task permutes (Spark's sort spills); a shard has as
    many bins as it needs. A task holds the labels of one block, the matrix row and one number per block.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    here = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    row = F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")])
    rows = materialise(df.select(row.alias("row"), F.spark_partition_id().alias("block"),
                                 here.alias("place")), "shuffle")
    counts = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}  # one number per task that wrote
    sizes = np.array([counts.get(b, 0) for b in range(max(counts, default=-1) + 1)], np.int64)
    before = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    total = int(before[-1])
    bins = max(1, -(-(total // shards + 1) // bin_rows))
    room = bin_sizes(total, shards, bins)
    shared = df.sparkSession.sparkContext.broadcast((before, room))

    @F.pandas_udf("long")
    def dealt(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        before, room = shared.value
        held, labels = -1, np.empty(0, np.int64)
        for block, place in parts:
            block, place = block.to_numpy(), place.to_numpy()
            out = np.empty(len(block), np.int64)
            for b in np.unique(block):
                if b != held:
                    sent = matrix_row(int(b), before, room, seed)
                    labels = np.random.default_rng([seed, int(b)]).permutation(np.repeat(np.arange(len(sent)), sent))
                    held = b
                out[block == b] = labels[place[block == b]]
            yield pd.Series(out)

    binned = rows.withColumn("bin", dealt("block", "place"))
    order = Window.partitionBy("bin").orderBy(F.xxhash64(F.lit(seed), "block", "place"), "block", "place")
    shard, part = F.expr(f"bin div {bins}"), F.col("bin") % bins
    size = F.lit(total // shards) + F.when(shard < total % shards, 1).otherwise(0)
    start = part * F.floor(size / bins) + F.least(part, size % bins)
    placed = binned.withColumn("slot", (start + F.row_number().over(order) - 1).cast("long"))
    return placed.select(*[F.col("row").getField(c).alias(c) for c in kept], shard.cast("int").alias("shard"), "slot")
