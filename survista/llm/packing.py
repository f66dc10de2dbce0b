"""Best-fit packing of token sequences under several capacities."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise, utf8
from survista.llm.tokens import encoder

PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text",
           byte_level: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each row's ids and the end id, cut where they exceed ``size``. All pieces
    but the first are full."""
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = encoder(tokenizer, byte_level).encode
        for b in batches:
            rows, out = [], []
            for i, text in enumerate(utf8(b.column(1))):
                ids = encode(text) + end
                n = len(ids) // 4
                starts = [0, *range(n - (n - 1) // size * size, n, size)]
                for k, (a, z) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    rows.append(i)
                    out.append((k, a, z - a, zlib.crc32(ids[4 * a:4 * z])))
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), *cols], ["id", "piece", "start", "length", "ids_crc32"])

    return spec.mapInArrow(cut, f"id {spec.schema['id'].dataType.simpleString()}, {PIECE}")


def demands(lengths: np.ndarray) -> np.ndarray:
    """What a piece takes of each capacity: tokens, one document, and the square of its length for attention."""
    n = np.asarray(lengths, np.float64)
    return np.stack([n, np.ones_like(n), n * n], axis=1)


def fit_by_norm(lengths: np.ndarray, caps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bin of each piece; pieces in falling length go to the open bin that has room in every capacity and is left
    with the smallest weighted norm of residuals, or to a new bin. Ties: the bin opened first."""
    order = np.argsort(-lengths, kind="stable")
    need = demands(lengths)[order]
    out = np.empty(len(lengths), np.int64)
    room, name, opened = np.empty((1024, 3)), np.empty(1024, np.int64), 0
    live, least = 0, need[-1] if len(need) else None
    scale = weights / (caps * caps)
    for i, d in zip(order.tolist(), need, strict=True):
        left = room[:live] - d
        cost = np.where((left >= 0).all(axis=1), (left * left) @ scale, np.inf)
        at = int(cost.argmin()) if live else -1
        if at < 0 or cost[at] == np.inf:
            if live == len(room):
                keep = np.flatnonzero((room >= least).all(axis=1))  # the others can take no piece any more
                k = len(keep)
                grown = max(1024, 2 * k)
                room, name = np.resize(room[keep], (grown, 3)) if k else np.empty((grown, 3)), np.resize(name[keep], grown) if k else np.empty(grown, np.int64)
                live = k
            at, live = live, live + 1
            room[at], name[at] = caps, opened
            opened += 1
        room[at] -= d
        out[i] = name[at]
    return out


def fit_by_dot(lengths: np.ndarray, caps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bin of each piece; one bin after the other takes, while any piece fits in every capacity, the fitting piece with
    the largest weighted dot product of its demands and the bin's residuals. Ties: the longer piece."""
    order = np.argsort(-lengths, kind="stable")
    kinds, first, count = np.unique(-lengths[order], return_index=True, return_counts=True)
    need = demands(-kinds)
    taken, out, opened = np.zeros(len(kinds), np.int64), np.empty(len(lengths), np.int64), 0
    scaled, rest = need * weights / caps, len(lengths)
    while rest:
        room = caps.astype(np.float64).copy()
        while True:
            fits = (taken < count) & (need <= room).all(axis=1)
            if not fits.any():
                break
            k = int(np.where(fits, scaled @ (room / caps), -1.0).argmax())
            out[order[first[k] + taken[k]]] = opened
            taken[k] += 1
            rest -= 1
            room -= need[k]
        opened += 1
    return out


def best_fit(lengths: np.ndarray, caps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rule that needs fewer bins."""
    a, b = fit_by_norm(lengths, caps, weights), fit_by_dot(lengths, caps, weights)
    return a if len(lengths) == 0 or a.max() <= b.max() else b


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, max_documents: int = 1024,
         max_attention: int | None = None, weights: tuple = (1.0, 0.05, 0.05), shard_pieces: int = 6_000,
         id_col: str = "doc_id", text_col: str = "text", byte_level: bool = True) -> DataFrame:
    """Pack all rows of ``docs`` into sequences of at most ``size`` tokens, ``max_documents`` pieces and
    ``max_attention`` (the sum of squared piece lengths). If None that is size squared, which no sequence exceeds: then it
    only weighs in the choice. A piece that exceeds a smaller one by itself, full pieces among them, is a sequence of its own.

    One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset. Null text counts as empty, which is
    the end id alone; null and repeated ids are packed like others. An empty table gives no rows; other columns are
    not read. Only documents longer than ``size`` are cut; full pieces are sequences of their own. The others are dealt at
    random to shards of about ``shard_pieces``, each packed in a task of its own: what a shard wastes is at most
    a few sequences, so the count stays within a small share of the total at any size of the input.
    """
    attention = size * size if max_attention is None else max_attention
    caps = np.array([size, max_documents, attention], np.float64)
    factor = np.array(weights)
    cut = materialise(pieces(docs, tokenizer, end_id, size, id_col, text_col, byte_level), "pieces")
    alone = (F.col("length") == size) | (F.col("length") * F.col("length") > attention)
    part = cut.filter(~alone)
    shards = max(1, -(-part.count() // shard_pieces))
    dealt = part.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = f"id {cut.schema['id'].dataType.simpleString()}, {PIECE}, sequence_id bigint, offset bigint"

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        rows["sequence_id"] = (np.int64(key[0]) << 32) + best_fit(lengths, caps, factor)
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows.drop(columns="shard")

    packed = dealt.groupBy("shard").applyInPandas(place, schema)
    full = cut.filter(alone).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.union(full).withColumnRenamed("id", id_col)
