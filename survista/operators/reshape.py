"""Set operations (ST1-ST3) and reshapes (RS4-RS6, RS8, RS9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col


# -- set operations ---------------------------------------------------------------
def borrow_rows(df: DataFrame, cond: Column, overrides: Mapping[str, Column | object]) -> DataFrame:
    """ST2: the rows of ``df``, and for each that matches ``cond`` a re-labelled
    copy (a statement shown again under another section). One read of ``df``:
    a row becomes an array of one or two."""
    own = F.struct(*[F.col(c) for c in df.columns])
    cells = {c: v if isinstance(v, Column) else F.lit(v) for c, v in overrides.items()}
    copy = F.struct(*[cells[c].cast(df.schema[c].dataType).alias(c) if c in cells else F.col(c) for c in df.columns])
    return df.select(F.explode(F.when(cond, F.array(own, copy)).otherwise(F.array(own))).alias("__r")).select("__r.*")


def union_sections(df: DataFrame, column: str, specs: Sequence[Sequence]) -> DataFrame:
    """ST3: a UNION ALL of several filtered section lists, as one scan with
    ``isin`` (each list tagged with its 1-based part number)."""
    tag = None
    for i, values in enumerate(specs, start=1):
        cond = F.col(column).isin(list(values))
        tag = (F.when if tag is None else tag.when)(cond, F.lit(i))
    return df.withColumn("part", tag).filter(F.col("part").isNotNull())


# -- reshapes ---------------------------------------------------------------------
def wide_crosstab(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], default: str = "") -> DataFrame:
    """RS6: one wide row per key with ``max(case when <cond> then value end)``
    per output column and ``default`` ('' in the source) for empty cells.
    ``columns`` maps output name -> ``when(cond, value)`` Column."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.max(c), F.lit(default)).alias(n) for n, c in columns.items()])


def unpivot_facts(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Column], label: str = "column_label",
                  value: str = "value", drop_nulls: bool = False) -> DataFrame:
    """RS8: turn several fact columns into (label, value) rows in one pass
    (``explode`` of an array of structs, no repeated scans)."""
    arr = F.array(*[F.struct(F.lit(n).alias("l"), v.cast("string").alias("v")) for n, v in spec.items()])
    out = df.select(*keys, F.explode(arr).alias("__u")).select(
        *keys, F.col("__u.l").alias(label), F.col("__u.v").alias(value))
    return out.filter(F.col(value).isNotNull()) if drop_nulls else out


def crosstab(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measures: Mapping[str, Column]) -> DataFrame:
    """RS9: report crosstab: row groups x dynamic column groups x measures."""
    out = df.groupBy(*rows).pivot(column, list(values)).agg(*[m.alias(n) for n, m in measures.items()])
    return out


def crosstab_groups(df: DataFrame, rows: Sequence[str], column: str, measures: Mapping[str, Column], name: str = "groups") -> DataFrame:
    """RS9 with column groups found when the query runs: one row per ``rows`` with an array ``name``, which has the same entries in
    the same order on every row - a struct (value, then the measures) for each value of ``column`` in the data, NULL first -
    and NULL measures where a row has none. The values are a scalar subquery of the plan; a value never seen before is one
    more entry. Dimensions are code lists, so the array is short."""
    values = df.agg(F.sort_array(F.collect_set(F.struct(F.col(column).alias("value"))))).scalar()
    cells = df.groupBy(*rows, column).agg(*[m.alias(n) for n, m in measures.items()])
    kinds = {f.name: f.dataType for f in cells.schema.fields}
    one = F.struct(F.col(column).alias("value"), *[F.col(n) for n in measures])
    found = cells.groupBy(*rows).agg(F.collect_list(one).alias("__cells"))

    def entry(v: Column) -> Column:
        empty = F.struct(v["value"].alias("value"), *[F.lit(None).cast(kinds[n]).alias(n) for n in measures])
        return F.coalesce(F.get(F.filter("__cells", lambda c: c["value"].eqNullSafe(v["value"])), F.lit(0)), empty)

    return found.withColumn("__values", values).select(*rows, F.transform("__values", entry).alias(name))


def pivot_first(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], value: str, order: Column) -> DataFrame:
    """AG26 as a matrix: for each column of ``columns`` (name -> condition) the value of the row that comes first by ``order``."""
    return df.groupBy(*keys).agg(*[F.min_by(F.when(c, F.col(value)), F.when(c, order)).alias(n) for n, c in columns.items()])
