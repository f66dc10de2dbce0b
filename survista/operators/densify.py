"""Gap filling (JN13, JN14): every organisation x year x item shown, with the
facts where they exist.

The skeleton is the product of *dimension* values (orgs, roster years,
submission modes), which is exactly the report's output size. It is built
without a cartesian join and without a job of its own: each dimension's
distinct values are one array (a scalar subquery), expanded per row of the
base with ``explode``. The facts are aggregated to the skeleton's grain first
and joined on equality keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def skeleton(base: DataFrame, dims: Mapping[str, DataFrame | Sequence]) -> DataFrame:
    """JN13: ``base`` x each dimension in ``dims`` (name -> one-column frame
    or literal list)."""
    out = base
    for name, dim in dims.items():
        if isinstance(dim, DataFrame):
            value = F.struct(F.col(dim.columns[0]).alias("v"))
            values = dim.agg(F.array_sort(F.collect_set(value))).scalar()
            out = out.withColumn(name, F.explode(values)).withColumn(name, F.col(f"{name}.v"))
        else:
            out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in dict.fromkeys(dim)])))
    return out


def densify(skel: DataFrame, facts: DataFrame, keys: Sequence[str], fill: Mapping[str, object] | None = None) -> DataFrame:
    """JN14: left-join the facts onto the skeleton on ``keys``; ``fill``
    replaces the NULLs of missing combinations (e.g. counts -> 0)."""
    out = skel.join(facts, list(keys), "left")
    for c, v in (fill or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
