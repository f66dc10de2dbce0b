"""Exact duplicates found by mergeable counting quotient filters."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise

#: Fingerprint bits: the leading ones name the shard, the rest are split into quotient and remainder.
BITS = 64
#: Values whose bits are packed at a time.
_STEP = 1 << 16


def packed(values: np.ndarray, r: int) -> np.ndarray:
    """The low ``r`` bits of each value, one after the other, as bytes."""
    step = [values[i:i + _STEP] for i in range(0, len(values), _STEP)]  # multiples of 8 values fill whole bytes
    bits = [np.packbits(np.unpackbits(v.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - r:]) for v in step]
    return np.concatenate(bits) if bits else np.zeros(0, np.uint8)


def unpacked(data: np.ndarray, n: int, r: int) -> np.ndarray:
    """``n`` values of ``r`` bits."""
    out = np.zeros(n, np.uint64)
    for i in range(0, n, _STEP):
        k = min(_STEP, n - i)
        bits = np.zeros((k, 64), np.uint8)
        bits[:, 64 - r:] = np.unpackbits(data[i * r // 8:(i + k) * r // 8 + 1])[:k * r].reshape(k, r)
        out[i:i + k] = np.packbits(bits, axis=1).view(">u8").ravel()
    return out


class CountingQuotientFilter:
    """Counts of ``width``-bit values, kept as runs of sorted remainders.

    The quotient (leading ``q`` bits) of a value is not stored: ``occupied`` has a bit for each quotient with a run,
    ``runend`` a bit for each slot that ends a run, and the ``n`` slots hold the remainders, ``width - q`` bits each,
    ascending in each run. Counts above one are kept beside the slots that have them. Quotient and remainder give the value back, so two filters
    merge without loss and without the values they were built from.
    """

    def __init__(self, q: int, n: int, occupied, runend, remainders, many, counts):
        self.q, self.n, self.occupied, self.runend = q, n, occupied, runend
        self.remainders, self.many, self.counts = remainders, many, counts

    @classmethod
    def of(cls, values: np.ndarray, counts: np.ndarray, width: int) -> CountingQuotientFilter:
        """From sorted distinct values below 2**width."""
        q = min(width - 1, max(1, int(len(values)).bit_length()))
        r = np.uint64(width - q)
        quotient = (values >> r).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        runend = np.append(quotient[1:] != quotient[:-1], True)[:len(values)]
        remainders = values & ((np.uint64(1) << r) - np.uint64(1))
        many = np.flatnonzero(counts > 1)
        return cls(q, len(values), np.packbits(occupied), np.packbits(runend), packed(remainders, width - q), many.astype(np.int64), counts[many])

    def items(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted values and their counts."""
        n = self.n
        runs = np.flatnonzero(np.unpackbits(self.occupied)[:1 << self.q])
        run = np.concatenate(([0], np.cumsum(np.unpackbits(self.runend)[:n])[:-1])).astype(np.int64)[:n]
        counts = np.ones(n, np.int64)
        counts[self.many] = self.counts
        return (runs[run].astype(np.uint64) << np.uint64(width - self.q)) | unpacked(self.remainders, n, width - self.q), counts

    def dump(self) -> bytes:
        head = np.array([self.q, self.n, len(self.many), len(self.remainders)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.many, self.counts.astype(np.int64), self.remainders, self.occupied, self.runend))

    @classmethod
    def load(cls, data: bytes) -> CountingQuotientFilter:
        q, n, k, size = (int(x) for x in np.frombuffer(data, np.int64, 4))
        many, counts = np.frombuffer(data, np.int64, k, 32), np.frombuffer(data, np.int64, k, 32 + 8 * k)
        at = 32 + 16 * k
        bits = (1 << q) + 7 >> 3
        return cls(q, n, np.frombuffer(data, np.uint8, bits, at + size), np.frombuffer(data, np.uint8, (n + 7) // 8, at + size + bits),
                   np.frombuffer(data, np.uint8, size, at), many, counts)


def merged(filters: list[CountingQuotientFilter], width: int) -> CountingQuotientFilter:
    """One filter with the counts of all: their items are merged in the order of quotient and remainder."""
    parts = [f.items(width) for f in filters]
    values = np.concatenate([v for v, _ in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], np.concatenate([c for _, c in parts])[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return CountingQuotientFilter.of(values[first], np.add.reduceat(counts, first) if len(first) else counts, width)


def repeated(prints: DataFrame, shard_bits: int) -> DataFrame:
    """(fp, n): the 64-bit fingerprints ``fp`` that occur more than once, and how often.

    Every task builds a filter of its rows for each of 2**shard_bits ranges of fingerprints. A shard's filters are
    merged in one task; its size is that of its distinct fingerprints, however often one of them occurs.
    """
    width = BITS - shard_bits

    def build(batches):
        seen: list = []
        for b in batches:
            seen.append(np.unique(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), return_counts=True))
            if len(seen) > 32:
                seen = [_summed(seen)]
        if not seen:
            return
        values, counts = _summed(seen)
        shard = (values >> np.uint64(width)).astype(np.int64) if shard_bits else np.zeros(len(values), np.int64)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
        low = (np.uint64(1) << np.uint64(width)) - np.uint64(1) if shard_bits else np.uint64(2**64 - 1)
        for a, z in zip(cuts, [*cuts[1:], len(shard)], strict=True):
            f = CountingQuotientFilter.of(values[a:z] & low, counts[a:z].astype(np.int64), width)
            yield pa.RecordBatch.from_arrays([pa.array([int(shard[a])]), pa.array([f.dump()], pa.binary())], ["shard", "filter"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values, counts = merged([CountingQuotientFilter.load(x) for x in rows["filter"]], width).items(width)
        found = counts > 1
        values = values[found] | (np.uint64(key[0]) << np.uint64(width)) if shard_bits else values[found]
        return pd.DataFrame({"fp": values.view(np.int64), "n": counts[found]})

    built = prints.select("fp").mapInArrow(build, "shard bigint, filter binary")
    return built.groupBy("shard").applyInPandas(merge, "fp bigint, n bigint")


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    values, back = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    counts = np.zeros(len(values), np.int64)
    np.add.at(counts, back, np.concatenate([c for _, c in parts]))
    return values, counts


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shard_rows: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest id stays. Rows
    whose fingerprint occurs once are done; the others are grouped by their whole text. Rows with a null id count in
    their group; keep_id is null only where the group has no id, and then all of its rows are kept. Rows that repeat an
    id and its text get the same answer. An empty table gives no rows; other columns are not read.

    ``shard_rows``: fingerprints that one merging task handles, more or less; sets the number of shards.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("fp", F.xxhash64("text"))
    marks = materialise(rows.select("id", "fp", F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "exact")
    shard_bits = max(0, (marks.count() // shard_rows).bit_length())
    again = materialise(repeated(marks, shard_bits), "exact-repeated")
    groups = (rows.join(again.select("fp"), "fp", "left_semi").groupBy("fp", "text")
              .agg(F.max("id").alias("keep"), F.count("*").alias("size"))
              .select("fp", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "keep", "size"))
    groups = materialise(groups, "exact-groups")
    found = marks.join(groups, ["fp", "sha"], "left")
    keep = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))
    return found.select(F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("size", F.lit(1)).alias("group_size"),
                        F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))
