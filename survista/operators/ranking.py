"""Ranking, top/bottom and ordering operators (WN4-WN7, JN9, SO1-SO5).

Rankings run over *aggregated* measures (one row per group x item), so a
window partition holds at most the number of items of a form. Every ranking
takes a full tie-breaker so results are deterministic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, columns


def _keys(x) -> list:
    return [] if x is None else ([x] if isinstance(x, str) else list(x))


def _order(measure: str, desc: bool, tie: Sequence[str], nulls_last: bool) -> list[Column]:
    m = F.col(measure)
    first = columns.nulls_last(measure, desc) if nulls_last else m.desc() if desc else m.asc()
    return [first] + [F.col(t).asc() for t in tie]


def top_bottom(df: DataFrame, group, measure: str, n: int, tie: Sequence[str] = (),
               nulls_last: bool = True, position: str = "position", rank: str = "rank",
               top_label: str = "Top", bottom_label: str = "Bottom") -> DataFrame:
    """WN4/WN5/ST1: top ``n`` and bottom ``n`` rows per group, stacked (UNION
    ALL) with a ``position`` tag and a 1-based ``rank``. NULL measures rank
    last in both directions. Both rankings share one window partitioning; a
    row that is in both lists is doubled after it."""
    g = _keys(group)
    w_top = Window.partitionBy(*g).orderBy(*_order(measure, True, tie, nulls_last))
    w_bot = Window.partitionBy(*g).orderBy(*_order(measure, False, tie, nulls_last))
    ranked = df.withColumn("__top", F.row_number().over(w_top)).withColumn("__bot", F.row_number().over(w_bot))
    tags = F.array(F.struct(F.lit(top_label).alias("p"), F.col("__top").alias("r")),
                   F.struct(F.lit(bottom_label).alias("p"), F.col("__bot").alias("r")))
    return (ranked.withColumn("__tag", F.explode(tags)).filter(F.col("__tag.r") <= n)
            .withColumn(position, F.col("__tag.p")).withColumn(rank, F.col("__tag.r"))
            .drop("__top", "__bot", "__tag"))


def top_bottom_join(df: DataFrame, group, item: str, measure: str, n: int, tie: Sequence[str] = (),
                    nulls_last: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """JN9: the rank-aligned pairing of the top-n and bottom-n lists per
    group: one row per (group, rank) with ``top_<item>``, ``top_<measure>``,
    ``bottom_<item>``, ``bottom_<measure>``. Done as one ranking pass and one
    conditional aggregate per (group, rank) instead of a self-join; the
    columns in ``carry`` come along, as ``top_`` and ``bottom_`` too."""
    g = _keys(group)
    w_top = Window.partitionBy(*g).orderBy(*_order(measure, True, tie, nulls_last))
    w_bot = Window.partitionBy(*g).orderBy(*_order(measure, False, tie, nulls_last))
    ranked = (df.withColumn("__top", F.row_number().over(w_top))
              .withColumn("__bot", F.row_number().over(w_bot)))
    rows = ranked.select(*g, item, measure, *carry, F.explode(F.array(
        F.struct(F.col("__top").alias("r"), F.lit(True).alias("is_top")),
        F.struct(F.col("__bot").alias("r"), F.lit(False).alias("is_top")))).alias("__x"))
    rows = rows.filter(F.col("__x.r") <= n)
    is_top = F.col("__x.is_top")
    return rows.groupBy(*g, F.col("__x.r").alias("rank")).agg(
        F.max(F.when(is_top, F.col(item))).alias(f"top_{item}"),
        F.max(F.when(is_top, F.col(measure))).alias(f"top_{measure}"),
        F.max(F.when(~is_top, F.col(item))).alias(f"bottom_{item}"),
        F.max(F.when(~is_top, F.col(measure))).alias(f"bottom_{measure}"),
        *[F.max(F.when(when, F.col(c))).alias(f"{side}_{c}") for c in carry for side, when in (("top", is_top), ("bottom", ~is_top))])


def rank_global(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """WN6: ``row_number() over (partition by 1 order by ...)``. A single
    partition: use only on reduced input (one row per statement/item)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy().orderBy(*order)))


def both_ends(df: DataFrame, group, measure: str, n: int, tie: Sequence[str] = (), name: str = "sequence",
              desc: bool = True) -> DataFrame:
    """WN7: keep rank <= n or rank > count - n per group (the general form
    of 'Sequence in (1,2,3,14,15,16)')."""
    g = _keys(group)
    w = Window.partitionBy(*g).orderBy(*_order(measure, desc, tie, True))
    cnt = F.count(F.lit(1)).over(Window.partitionBy(*g))
    return (df.withColumn(name, F.row_number().over(w)).withColumn("__cnt", cnt)
            .filter((F.col(name) <= n) | (F.col(name) > F.col("__cnt") - n)).drop("__cnt"))


def sort_totals_last(df: DataFrame, bits: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """SO1: details before their subtotals: order by each bit then its column."""
    order = []
    for b, c in zip(bits, cols):
        order += [F.col(b), F.col(c)]
    order += [F.col(c) for c in cols[len(bits):]]
    return df.orderBy(*order)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """SO2: ``TOP n ... ORDER BY`` (TakeOrderedAndProject: a per-partition
    top-n then one merge of n rows per partition)."""
    return df.orderBy(*order).limit(n)


def first_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """SO3: ``TOP 1`` as a default pick."""
    return top_n(df, order, 1)


def roster_years(df: DataFrame, year: str = "start_year", n: int = 3, which: str = "latest") -> DataFrame:
    """SO4: three distinct years in ascending order, either the ``latest``
    three (inner DESC TOP, outer ASC: the evident intent) or the
    ``earliest`` three (what the query literally returns, since an ORDER BY
    under ``TOP 100 PERCENT`` does not order)."""
    years = df.select(year).distinct()
    picked = years.orderBy(F.col(year).desc() if which == "latest" else F.col(year).asc()).limit(n)
    return picked.orderBy(year)
