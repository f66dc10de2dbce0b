"""Organisation-hierarchy rollups (AG10-AG14, AG18, AG19, AG28).

A rollup is one ``Expand`` (n+1 copies of each input row, one per level)
feeding a hash aggregate with map-side partial aggregation, so hot
organisations are pre-combined before the shuffle. Aggregate the input to
the finest grain needed *before* rolling up and the expansion stays small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pct_of, ratio_half_up


def rollup_by(df: DataFrame, hierarchy: Sequence[str], keys: Sequence[str], aggs: Sequence[Column],
              labels: Mapping[str, str] | None = None, bits: Mapping[str, str] | None = None,
              rename: Mapping[str, str] | None = None, levels: int | None = None) -> DataFrame:
    """AG10/AG11: ``GROUP BY ROLLUP(h1..hn), k1..km``.

    Adds ``<h>_sort_bit`` (``grouping(h)`` as int) for each hierarchy column
    (names overridable via ``bits``). ``labels`` maps a hierarchy column to
    its subtotal label (``case when grouping(h)=0 then h else label end``);
    without a label the subtotal cell stays NULL. ``levels`` limits how far
    up the rollup goes (default: to the grand total).
    """
    h, k = list(hierarchy), list(keys)
    top = 0 if levels is None else max(0, len(h) - levels)
    sets = [h[:i] + k for i in range(len(h), top - 1, -1)]
    bit_cols = [F.grouping(c).cast("int").alias((bits or {}).get(c, f"{c}_sort_bit")) for c in h]
    out = df.groupingSets(sets, *h, *k).agg(*aggs, *bit_cols)
    for c in h:
        name = (rename or {}).get(c, c)
        label = (labels or {}).get(c)
        bit = (bits or {}).get(c, f"{c}_sort_bit")
        if label is not None:
            out = out.withColumn(name, F.when(F.col(bit) == 0, F.col(c)).otherwise(F.lit(label)))
            if name != c:
                out = out.drop(c)
        elif name != c:
            out = out.withColumnRenamed(c, name)
    return out


def rollup_regroup(df: DataFrame, hierarchy: Sequence[str], item: str, weight: str,
                   sums: Mapping[str, Column], total: str = "Total") -> DataFrame:
    """AG13: ``rollup(h.., item), weight`` then regroup by (h.., item, weight).

    The rollup makes one subtotal row per distinct weight; the weight is
    NULLed on subtotal rows and the second group-by merges them into one.
    Subtotal labels are ``total`` for the hierarchy and item columns.
    """
    cols = list(hierarchy) + [item]
    # to the finest grain first: the expansion then copies group rows, not input rows
    df = df.groupBy(*cols, weight).agg(*[a.alias(n) for n, a in sums.items()])
    sets = [cols[:i] + [weight] for i in range(len(cols), -1, -1)]
    aggs = [F.sum(n).alias(n) for n in sums]
    first = (df.groupingSets(sets, *cols, weight)
             .agg(*aggs, *[F.grouping(c).cast("int").alias(f"__g_{c}") for c in cols]))
    proj = [F.when(F.col(f"__g_{c}") == 0, F.col(c)).otherwise(F.lit(total)).alias(c) for c in cols]
    proj.append(F.when(F.col(f"__g_{item}") == 0, F.col(weight)).alias(weight))
    return (first.select(*proj, *sums.keys())
            .groupBy(*cols, weight).agg(*[F.sum(n).alias(n) for n in sums]))


def item_pct_of_sample(detail: DataFrame, org: str, entity: str, item_keys: Sequence[str], yes: str,
                       total_label: str = "State", precision: int = 5, scale: int = 1,
                       total_only: bool = False) -> DataFrame:
    """AG19: per organisation (and the all-org total) and item: the item's
    yes count over the organisation's sample size (distinct entities).

    Two rollups over org - the sample sizes and the item yes counts - joined
    on the org label *and* the sort bit, so a real org called like the total
    label cannot collide. Percent = round(yes*100/n, 2) then cast to
    decimal(precision, scale) (double rounding kept on purpose). Both rollups
    start from rows already reduced to their grain. ``total_only`` leaves the
    organisations out and gives the total's rows alone.
    """
    yes_counts = detail.groupBy(org, *item_keys).agg(F.sum(F.col(yes)).cast("long").alias("yes_count"))
    if total_only:
        total = [F.lit(total_label).alias(org), F.lit(1).alias("sort_bit")]
        samples = detail.agg(F.count_distinct(F.col(entity)).alias("n_size")).select(*total, "n_size")
        counts = yes_counts.groupBy(*item_keys).agg(F.sum("yes_count").alias("yes_count")).select(*total, *item_keys, "yes_count")
    else:
        samples = rollup_by(detail.select(org, entity).distinct(), [org], [], [F.count_distinct(F.col(entity)).alias("n_size")],
                            labels={org: total_label}, bits={org: "sort_bit"})
        counts = rollup_by(yes_counts, [org], list(item_keys), [F.sum("yes_count").alias("yes_count")],
                           labels={org: total_label}, bits={org: "sort_bit"})
    joined = counts.join(samples, [org, "sort_bit"], "left")
    pct = ratio_half_up("yes_count", "n_size", scale=2, times=100).cast(f"decimal({precision},{scale})")
    return joined.withColumn("item_pct", pct)
