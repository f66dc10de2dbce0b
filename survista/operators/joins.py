"""Join operators (JN1-JN4, JN6-JN12, JN15-JN16).

Join strategy is left to the planner with AQE on: it broadcasts a side only
once the side's measured size is under ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles both sides by the key (with skew splitting). Explicit
broadcast hints are used only for inline code tables, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_left_residual(a: DataFrame, b: DataFrame, on: Column, residual: Column) -> DataFrame:
    """JN4: equi-join key plus a non-equi residual in the ON clause (may fan out)."""
    return a.join(b, on & residual, "left")


def decode(df: DataFrame, code_col: str, lookup: DataFrame, out: str, code: str = "code",
           name: str = "name", fallback: bool = True, when: Column | None = None) -> DataFrame:
    """JN6: code -> name via a lookup. With ``fallback`` an unknown code keeps
    its code (``coalesce(name, code)``); without, it becomes NULL. ``when``
    restricts which rows are decoded (the other rows get NULL unless
    ``fallback``). The planner broadcasts the lookup if its size allows."""
    lk = lookup.select(F.col(code).alias("__code"), F.col(name).alias("__name"))
    cond = F.col(code_col) == F.col("__code")
    if when is not None:
        cond = cond & when
    joined = df.join(lk, cond, "left")
    value = F.coalesce(F.col("__name"), F.col(code_col)) if fallback else F.col("__name")
    return joined.withColumn(out, value).drop("__code", "__name")


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """JN11: NULL-aware ``key NOT IN (select other_key from other)``.

    SQL semantics: a NULL in the subquery makes every comparison unknown (no
    row survives); a NULL key survives only when the subquery is empty.
    Row count and non-NULL count of the subquery are scalar subqueries of the
    plan; the row filtering itself is an equality anti join, so no nested-loop
    join is planned for a large subquery and no job runs before the query.
    """
    other_key = other_key or key
    n = other.agg(F.count(F.lit(1))).scalar()
    nulls = other.agg(F.count(F.when(F.col(other_key).isNull(), 1))).scalar()
    keys = other.select(F.col(other_key).alias("__k")).distinct()
    return (df.join(keys, F.col(key) == F.col("__k"), "left_anti")
            .filter((n == 0) | ((nulls == 0) & F.col(key).isNotNull())))


def having_rows(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """JN16: keep rows whose key occurs in ``other`` (derived-table EXISTS)."""
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def drop_all_null(df: DataFrame, entity: Sequence[str] | str, value: str) -> DataFrame:
    """JN12 + AG15: drop the entities whose ``value`` is NULL on every row
    (``having count(value) = 0`` then anti join)."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    empty = df.groupBy(*keys).agg(F.count(F.col(value)).alias("__n")).filter(F.col("__n") == 0)
    return df.join(empty.select(*keys), keys, "left_anti")


def keep_answered(df: DataFrame, entity: Sequence[str] | str, value: str) -> DataFrame:
    """AG29: keep entities with ``count(value) > 0`` (aggregate + semi join)."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    good = df.groupBy(*keys).agg(F.count(F.col(value)).alias("__n")).filter(F.col("__n") > 0)
    return df.join(good.select(*keys), keys, "left_semi")
