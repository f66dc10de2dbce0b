"""Scans, inline code tables, views and the CSV sink (SC1-SC4)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_text
from ..schemas import TABLES


def load(spark: SparkSession, path: str, fmt: str = "parquet",
         tables: Iterable[str] | None = None, options: dict | None = None, upper_ids: bool = True,
         any_case: bool = False) -> dict[str, DataFrame]:
    """SC1: lazily read the native tables found under ``path/<name>`` (a JDBC
    source: the tables of that name) in their declared schemas. A table that
    lacks a declared column, or has it in a type that does not widen to the
    declared one, is refused before anything runs; other columns are dropped.
    Ids are upper-cased, so that keys written in either case meet; with
    ``any_case`` all text compares so (see ``ignore_case``). Catalyst pushes each
    report's filters and column needs into these scans."""
    out = {}
    for name in tables or TABLES:
        reader = spark.read.format(fmt).options(**(options or {}))
        if fmt == "jdbc":
            df = reader.option("dbtable", name).load()
        else:
            df = reader.load(f"{path.rstrip('/')}/{name}")
        df = _declared(name, df, upper_ids)
        out[name] = ignore_case(df) if any_case else df
    return out


def ignore_case(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Give text columns (all, or those named) a case-insensitive collation, as
    the source's database compares: filters, joins, grouping, DISTINCT and
    ordering then treat spellings that differ in case as one. A group shows one
    of its spellings. Filters on such columns are not pushed into the scan."""
    chosen = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"} & set(columns or df.columns)
    return df.select(*[F.collate(F.col(c), "UTF8_LCASE").alias(c) if c in chosen else F.col(c) for c in df.columns])


#: Types that a declared type takes without loss.
_WIDENS = {"string": {"string", "varchar", "char"}, "int": {"int", "smallint", "tinyint"}, "double": {"double", "float", "int", "smallint", "tinyint"},
           "boolean": {"boolean"}, "date": {"date"}, "timestamp": {"timestamp", "timestamp_ntz", "date"}}


def _declared(name: str, df: DataFrame, upper_ids: bool) -> DataFrame:
    found = {f.name.lower(): f for f in df.schema.fields}
    wrong, columns = [], []
    for f in TABLES[name].fields:
        here = found.get(f.name)
        kind = here and here.dataType.simpleString().split("(")[0]
        if here is None:
            wrong.append(f"{f.name} is missing")
        elif kind not in _WIDENS[f.dataType.simpleString()]:
            wrong.append(f"{f.name} is {kind}, not {f.dataType.simpleString()}")
        else:
            c = F.col(here.name).cast(f.dataType)
            is_id = upper_ids and f.dataType.simpleString() == "string" and (f.name == "id" or f.name.endswith("_id"))
            columns.append((F.upper(c) if is_id else c).alias(f.name))
    if wrong:
        raise ValueError(f"table {name}: {'; '.join(wrong)}")
    return df.select(*columns)


def code_table(spark: SparkSession, rows: Sequence[tuple], cols: str | Sequence[str]) -> DataFrame:
    """SC2: an inline ``VALUES`` list. Its size is fixed by the literal, so it
    is always safe to broadcast and is marked so here."""
    schema = cols if isinstance(cols, str) else None
    names = None if schema else list(cols)
    df = spark.createDataFrame(list(rows), schema=schema or names)
    return F.broadcast(df)


def register_views(spark: SparkSession, t: dict[str, DataFrame], views: dict | None = None) -> None:
    """SC3: expose base tables, and optionally derived views (name -> function
    of ``t``), as session temp views for SQL users."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    for name, fn in (views or {}).items():
        fn(t).createOrReplaceTempView(name)


def persist(df: DataFrame, name: str, path: str, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """SC3: write a table or view once under ``path`` and read it from there.
    With a ``key`` it becomes the session table ``name``, bucketed and sorted by
    the key, so that joins and aggregates on the key need no exchange; tables to
    be joined take the same number of ``buckets`` (default: the session's
    shuffle partitions). A key should be spread as evenly as ids are."""
    spark = df.sparkSession
    if key is None:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key)
     .option("compression", "zstd").option("path", f"{path}/{name}").saveAsTable(name))
    return spark.table(name)


def write_csv(df: DataFrame, path: str, clean_columns: Iterable[str] = (), mode: str = "overwrite") -> None:
    """SC4: spreadsheet export. Listed text columns are cleaned of line breaks
    and markup first so each record stays on one CSV line. Written in parallel
    by the executors (one file per partition), never through the driver."""
    clean = set(clean_columns)
    out = df.select(*[clean_text(c).alias(c) if c in clean else F.col(c) for c in df.columns])
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)
