"""Row filters (FI1-FI14)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col, optional_eq

def keep_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """FI1: ``column IN (values)``."""
    return df.filter(F.col(column).isin(list(values)))


def drop_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """FI2: ``column NOT IN (values)``; a NULL column value is dropped as in SQL."""
    return df.filter(~F.col(column).isin(list(values)))


def active(df: DataFrame, deleted: str | None = "deleted_date",
           reliability: str | None = "reliability_check_of_submissions_id",
           excluded: str | None = None) -> DataFrame:
    """FI3: keep live rows: not soft-deleted, not a reliability re-check, not
    excluded. Column names that are None are skipped."""
    cond = F.lit(True)
    for c in (deleted, reliability, excluded):
        if c:
            cond = cond & F.col(c).isNull()
    return df.filter(cond)


def left_join_active(left: DataFrame, right: DataFrame, on: Column | list, right_cond: Column) -> DataFrame:
    """FI4: a LEFT JOIN whose ON clause carries a filter on the right side:
    the left row is kept and the right columns become NULL when it fails."""
    cond = on if isinstance(on, Column) else None
    if cond is None:
        return left.join(right.filter(right_cond), on, "left")
    return left.join(right, cond & right_cond, "left")


def restrict_to_user(df: DataFrame, grants: DataFrame, user_id: str, org: str = "org_unit_id",
                     grant_user: str = "user_profile_id", grant_org: str = "org_unit_id") -> DataFrame:
    """FI5: ``org IN (select org from grants where user = @user)``. Rows with a
    NULL org never match. Planned as a semi join; the per-user grant list is
    tiny, so AQE turns it into a broadcast once its size is measured."""
    allowed = (grants.filter(F.col(grant_user) == F.lit(user_id))
               .select(F.col(grant_org).alias("__org")).distinct())
    return df.join(allowed, F.col(org) == F.col("__org"), "left_semi")


def optional_filter(df: DataFrame, column: str, value, all_value: str = "All",
                    width: int | None = 10) -> DataFrame:
    """FI6: add ``left(column, width) = value`` only when value is not 'All'."""
    if value is None or value == all_value:
        return df
    return df.filter(optional_eq(column, value, all_value, width))


def years_in_window(years: DataFrame, as_of, back: int = 2, start: str = "start_date",
                    end: str = "end_date", start_year: str = "start_year") -> DataFrame:
    """FI11: roster years whose start year belongs to a year with
    ``start <= as_of <= end + back years`` (the 3-year comparison window).
    ``as_of`` is a parameter (date or ISO string) for determinism."""
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    d = F.to_date(F.lit(str(as_of)))
    hit = (years.filter((F.col(start) <= d) & (d <= F.add_months(F.col(end), 12 * back)))
           .select(F.col(start_year).alias("__sy")).distinct())
    return years.join(hit, F.col(start_year) == F.col("__sy"), "left_semi")


def branch_flag(flag: DataFrame | bool) -> Column:
    """FI12: a scalar condition as a column. A one-cell frame is a scalar
    subquery of the plan (no row or NULL: false); one with several rows fails
    when the query runs."""
    if isinstance(flag, DataFrame):
        cell = flag.select(F.col(flag.columns[0]).cast("boolean").alias("c")).scalar()
        return F.coalesce(cell, F.lit(False))
    return F.lit(flag)


def branch_if(df: DataFrame, flag: DataFrame | bool) -> DataFrame:
    """FI12: keep ``df``'s rows only when a scalar condition holds."""
    return df.filter(branch_flag(flag))


def keep_levels(df: DataFrame, level: str, bits: Sequence[str]) -> DataFrame:
    """FI13: keep only one level of a rolled-up result. ``bits`` are the sort
    bit columns from the top of the hierarchy down; ``level`` is 'detail', one
    of the hierarchy names 'top'/'<n>' (keep rows aggregated to that depth), or
    'total'."""
    n = len(bits)
    depth = {"detail": n, "total": 0, "top": 1}.get(level)
    if depth is None:
        depth = int(level)
    cond = F.lit(True)
    for i, b in enumerate(bits):
        cond = cond & (F.col(b) == F.lit(0 if i < depth else 1))
    return df.filter(cond)
