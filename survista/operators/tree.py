"""Form-layout tree operators: recursive flatten (RS1), parent/child attach
(JN7) and per-path sequencing (WN1-WN3, WN8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col


def flatten_tree(nodes: DataFrame, id: str = "id", parent: str = "parent_id", seq: str = "sequence",
                 roots: Column | None = None, keep: Sequence[str] = (), max_depth: int = 100) -> DataFrame:
    """RS1: walk an adjacency list from its roots down.

    Output per reachable node: ``root_id``, ``level`` (0 at the root),
    ``path`` (``100 + sequence`` of each level, joined by ``_``),
    ``path_key`` (array of sequences, the correct sort key also when a
    sequence is >= 900) plus the node's own columns listed in ``keep``.

    ``roots`` selects the anchor rows (default: ``parent IS NULL``); pass the
    template filter here - Spark does not push a filter into a recursion's
    anchor. Runs as a recursive CTE: each level is one distributed join of
    the frontier with the node table. A walk deeper than ``max_depth`` (a
    cycle) raises; the number of nodes is not limited (Spark's row limit for
    recursions is lifted in the session).
    """
    nodes.sparkSession.conf.set("spark.sql.cteRecursionRowLimit", -1)
    anchor = roots if roots is not None else F.col(parent).isNull()
    base = nodes.select(F.col(id).alias("n_id"), F.col(parent).alias("n_parent"),
                        F.col(seq).cast("int").alias("n_seq"),
                        *[F.col(k).alias(f"n_{k}") for k in keep])
    seeds = nodes.filter(anchor).select(F.col(id).alias("s_id"))
    keep_anchor = "".join(f", b.`n_{k}`" for k in keep)
    keep_step = "".join(f", c.`n_{k}`" for k in keep)
    keep_out = "".join(f", `n_{k}` AS `{k}`" for k in keep)
    sql = f"""
    WITH RECURSIVE walk MAX RECURSION LEVEL {int(max_depth)} AS (
        SELECT b.n_id, b.n_parent, b.n_seq, b.n_id AS root_id, 0 AS level,
               CAST(100 + b.n_seq AS STRING) AS path, array(b.n_seq) AS path_key{keep_anchor}
        FROM {{base}} b LEFT SEMI JOIN {{seeds}} s ON b.n_id = s.s_id
        UNION ALL
        SELECT c.n_id, c.n_parent, c.n_seq, w.root_id, w.level + 1,
               concat(w.path, '_', CAST(100 + c.n_seq AS STRING)), concat(w.path_key, array(c.n_seq)){keep_step}
        FROM {{base}} c JOIN walk w ON c.n_parent = w.n_id
    )
    SELECT n_id AS `{id}`, n_parent AS `{parent}`, n_seq AS `{seq}`, root_id, level, path, path_key{keep_out}
    FROM walk
    """
    return nodes.sparkSession.sql(sql, base=base, seeds=seeds)


def attach_parent(tree: DataFrame, id: str = "id", parent: str = "parent_id",
                  columns: Sequence[str] = (), prefix: str = "parent_", parents: DataFrame | None = None) -> DataFrame:
    """JN7: self-join each node to its parent row (inner: roots drop out).
    ``parents`` is the node table to look parents up in (default ``tree``)."""
    p = (tree if parents is None else parents).select(F.col(id).alias("__pid"), *[F.col(c).alias(prefix + c) for c in columns])
    return tree.join(p, F.col(parent) == F.col("__pid"), "inner").drop("__pid")


def sequence(df: DataFrame, part: Sequence[str] | str, order: Sequence[Column | str], name: str,
             desc: bool = False) -> DataFrame:
    """WN1/WN3: ``row_number() over (partition by part order by order)``
    (``desc`` reverses every order key). Partitions are form sections or
    templates - bounded by the form definition."""
    keys = [part] if isinstance(part, str) else list(part)
    o = [col(c) for c in order]
    if desc:
        o = [c.desc() for c in o]
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*o)))


def flag_last(df: DataFrame, part: Sequence[str] | str, order: Sequence[Column | str], name: str) -> DataFrame:
    """WN2: 1 on the last row of each partition (``row_number() desc = 1``)."""
    tmp = f"__{name}_rn"
    return sequence(df, part, order, tmp, desc=True).withColumn(
        name, (F.col(tmp) == 1).cast("int")).drop(tmp)


def sequence_by_expr(df: DataFrame, exprs: Sequence[Column], name: str,
                     part: Sequence[str] | str | None = None) -> DataFrame:
    """WN8: sequence rows by computed keys (e.g. a CASE rename) over the whole
    (small, already reduced) input or within ``part``."""
    w = Window.partitionBy(*([part] if isinstance(part, str) else list(part))) if part else Window.partitionBy()
    return df.withColumn(name, F.row_number().over(w.orderBy(*exprs)))
