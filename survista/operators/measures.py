"""Aggregate measures (AG1-AG9, AG15-AG17, AG20-AG27) as Column builders and
small DataFrame helpers. All are native aggregate expressions, so Spark runs
them with partial (map-side) aggregation before any shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, ratio_half_up


def count_where(cond: Column) -> Column:
    """AG3: ``count(case when cond then 1 end)``."""
    return F.count(F.when(cond, F.lit(1)))


def pct_met(met: Column, met_or_not: Column) -> Column:
    """AG5: ``sum(met)/sum(met or not met)*100`` with NULL-preserving sums:
    a group with no 'Met' gives NULL, not 0 (S7); output money (decimal 19,4)."""
    m = F.sum(F.when(met, F.lit(1)))
    d = F.sum(F.when(met_or_not, F.lit(1)))
    return ratio_half_up(m, d, scale=4, precision=19, times=100)


def pct_gt_all(c, cut: int = 3) -> Column:
    """AG8: share scoring above ``cut`` counting blanks as 0 (differs from AG7)."""
    return F.avg(F.when(col(c) > cut, F.lit(1)).otherwise(F.lit(0)).cast("double"))


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG17: group by every column == distinct."""
    return (df.select(*cols) if cols else df).distinct()


def threshold_flag(df: DataFrame, entity: Sequence[str] | str, cond: Column, n: int, name: str) -> DataFrame:
    """AG20: 1 on every row of an entity having at least ``n`` rows meeting
    ``cond``, else 0. A window over the entity: one read of ``df``, and after a
    join on the entity no exchange of its own. A large entity's rows spill."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return df.withColumn(name, (count_where(cond).over(Window.partitionBy(*keys)) >= n).cast("int"))


def any_match(value: Column, target: str) -> Column:
    """AG21: ``max(case when value = target then 1 else 0 end)``."""
    return F.max(F.when(value == F.lit(target), F.lit(1)).otherwise(F.lit(0)))


def nonzero_mean(pct: Column) -> Column:
    """AG24: mean of percents ignoring NULL and 0, as a fraction (pct/100)."""
    return F.avg(F.when(pct != 0, pct.cast("double") / F.lit(100.0)))


def yes_rate(yes: Column, no: Column) -> Column:
    """AG25: ``IIf(yes+no > 0, yes/(yes+no), 0)``."""
    return F.when(yes + no > 0, yes.cast("double") / (yes + no).cast("double")).otherwise(F.lit(0.0))


def first_ordered(c, order) -> Column:
    """AG26: a deterministic 'first' value per group: the value of the row
    with the smallest ``order`` key (``min_by``)."""
    return F.min_by(col(c), col(order))
