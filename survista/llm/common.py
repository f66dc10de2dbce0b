"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from survista.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths that ``shared_path`` gave out, by application.
_GIVEN: dict[str, list[str]] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that the session names in ``spark.checkpoint.dir``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/survista/{name}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def intermediate_paths(spark: SparkSession) -> list[str]:
    """Where the operators of this session have written so far, oldest first. Their results read from there until they are
    written elsewhere."""
    return list(_GIVEN.get(spark.sparkContext.applicationId, []))


def delete_intermediates(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete what the operators of this session wrote on their way (or only ``paths`` of ``intermediate_paths``). To be
    called when their results are written: results that are still lazy cannot be read afterwards."""
    given = _GIVEN.get(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in list(given) if paths is None else [p for p in paths if p in given]:
        place = hadoop.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        given.remove(path)


def materialise(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage starts at the written
    files, so a lost executor costs its running tasks only. With a ``key`` each task writes its rows in buckets
    by it (as many as the session's shuffle partitions), so that what needs the rows of a key together reads them
    without an exchange."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    to = df.write.option("compression", "zstd")
    if key is None:
        to.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    table = f"survista_{uuid.uuid4().hex}"
    to.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and with them what was read
    return kept


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null becomes the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
