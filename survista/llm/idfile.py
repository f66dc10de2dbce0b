"""Token ids in files of range-coded blocks.

A file is a row group of container rows in a Parquet folder, readable from any store that Spark reads. A row is a block:
its place (shard, block), the ids and lengths of its documents, crc32 of its ids, and the coded payload. Blocks hold
whole documents and decode on their own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from survista.llm import range_coder
from survista.llm.common import shared_path, utf8
from survista.llm.tokens import encoder


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
          byte_level: bool = False, block_ids: int = 1 << 22) -> None:
    """Write the ids of every row of ``docs``, ``end_id`` after each, ascending by id (then text; null ids first).

    The rows are range-partitioned by id; a task encodes its range in order. A block ends with the document that brings
    it to ``block_ids`` ids, so its length is bounded by that and the longest document.
    """
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = spec.repartitionByRange("id").sortWithinPartitions("id", "text")
    kind = spec.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def coded(batches):
        encode, shard, block = encoder(tokenizer, byte_level).encode, TaskContext.get().partitionId(), 0
        names, lengths, parts, held = [], [], [], 0

        def row():
            raw = b"".join(parts)
            payload = range_coder.encode(np.frombuffer(raw, "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block]), pa.array([names], pa.list_(types)), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([len(raw) // 4]), pa.array([zlib.crc32(raw)]), pa.array([payload], pa.binary())],
                ["shard", "block", "ids", "lengths", "n_ids", "crc", "payload"])

        types = None
        for b in batches:
            types = b.column(0).type
            for name, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                ids = encode(text) + end
                names.append(name)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                held += len(ids) // 4
                if held >= block_ids:
                    yield row()
                    names, lengths, parts, held, block = [], [], [], 0, block + 1
        if parts:
            yield row()

    ordered.mapInArrow(coded, f"shard int, block bigint, ids array<{kind}>, lengths array<bigint>, n_ids bigint, crc bigint, payload binary").write.parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of each document in the files at ``path``, from the decoded ids; start counts
    the ids of all documents before it. A damaged block raises ValueError."""
    blocks = spark.read.parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (blocks.select("shard", "block", "n_ids").withColumn("inside", inside)
              .join(shards.select("shard", before.alias("before")), "shard")
              .select("shard", "block", (F.col("before") + F.col("inside")).alias("first")))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def decoded(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                raw = range_coder.decode(b.column("payload")[0].as_py()).astype("<u4").tobytes()
                if zlib.crc32(raw) != b.column("crc")[0].as_py():
                    raise ValueError("ids differ from those written")
                lengths = np.array(b.column("lengths")[0].as_py(), np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(raw[4 * (z - n):4 * z]) for z, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                k = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [b.column("shard").take(pa.array([0] * k)), b.column("block").take(pa.array([0] * k)), b.column("ids")[0].values,
                     pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    ["shard", "block", "id", "inner", "n_tokens", "ids_crc32"])

    docs = blocks.select("shard", "block", "ids", "lengths", "crc", "payload").mapInArrow(
        decoded, f"shard int, block bigint, id {kind}, inner bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(starts, ["shard", "block"]).select(
        F.col("id").alias(id_col), (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
               byte_level: bool = False) -> DataFrame:
    """Write ``docs`` to the shared folder and read the documents back from the files. Null text counts as empty: the end
    id alone. Rows with null or repeated ids are documents like others, null ids first, repeated ones by text. An
    empty table writes no block and gives no rows; other columns are not read."""
    path = shared_path(docs.sparkSession, "ids")
    write(docs, path, tokenizer, end_id, id_col, text_col, byte_level)
    return read(docs.sparkSession, path, id_col)
