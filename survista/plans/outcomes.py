"""Post-school outcome reports (RP8-RP13) over record and formlet KAV rows.

Plan shape: record KAV -> (broadcast code decode) -> pivot by instance
(shuffle 1, partial aggregation) ; answers -> any-match flag by instance
(shuffle 2) ; left join on instance (co-partitioned) -> Expand (levels+1)
-> count(distinct instance) + sum (two-level partial aggregation).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import AU_TOTAL, DISTRICT_TOTAL, STATE_TOTAL, null_or_eq, pct_of
from ..operators.eav import pivot_attributes, safe_names
from ..operators.filters import restrict_to_user
from ..operators.hierarchy import rollup_by
from ..operators.joins import decode
from ..operators.measures import any_match, first_ordered
from ..operators.reshape import pivot_first

# Dimension codes of the parameterised report: D/E/G/R.
DIMENSIONS = {"D": "disability", "E": "exit_reason", "G": "gender", "R": "race"}


def pso_rollup(record_kav: DataFrame, answers: DataFrame, question_id, district_attr: str, school_attr: str,
               dimension_attr: str, lookup: DataFrame | None = None, fallback: bool = False, levels: int = 3,
               grants: DataFrame | None = None, user_id: str | None = None, roster_year=None,
               record_set_id=None, met: str = "Met", submission_mode_id=None) -> DataFrame:
    """Rollup AU -> District -> School (``levels`` deep) x dimension of:
    ``n_size`` (distinct instances), ``met_count`` (instances whose answer to
    ``question_id`` is ``met``), ``pct`` decimal(5,2), and the sort bits.

    ``record_kav`` columns: instance_id, org_unit_id, au, attribute_id, value
    (+ roster_year / record_set_id / submission_mode_id when those filters are used). ``answers``:
    instance_id, attribute_id, value. ``lookup`` (code, name) decodes the
    dimension, keeping unknown codes when ``fallback`` else NULL.
    """
    rk = record_kav
    if grants is not None and user_id is not None:
        rk = restrict_to_user(rk, grants, user_id)
    if roster_year is not None:
        rk = rk.filter(F.col("roster_year") == F.lit(roster_year))
    if record_set_id is not None:
        rk = rk.filter(null_or_eq("record_set_id", record_set_id))
    if submission_mode_id is not None:
        rk = rk.filter(F.col("submission_mode_id") == F.lit(submission_mode_id))
    dim_value = F.col("value")
    if lookup is not None:
        rk = decode(rk, "value", lookup, out="__dim", fallback=fallback,
                    when=F.col("attribute_id") == F.lit(dimension_attr))
        dim_value = F.col("__dim")
    wide = pivot_attributes(rk, ["instance_id", "au"],
                            {district_attr: "district", school_attr: "school", dimension_attr: "dimension"},
                            values={dimension_attr: dim_value})
    flag = (answers.filter(F.col("attribute_id") == F.lit(question_id))
            .groupBy("instance_id").agg(any_match(F.col("value"), met).alias("answer")))
    joined = wide.join(flag, "instance_id", "left")
    hierarchy = ["au", "district", "school"][:levels]
    labels = {"au": STATE_TOTAL, "district": AU_TOTAL, "school": DISTRICT_TOTAL}
    names = {"au": "admin_unit", "district": "district", "school": "school"}
    bits = {"au": "au_sort_bit", "district": "district_sort_bit", "school": "school_sort_bit"}
    out = rollup_by(joined, hierarchy, ["dimension"],
                    [F.count_distinct("instance_id").alias("n_size"),
                     F.sum("answer").cast("long").alias("met_count")],
                    labels={h: labels[h] for h in hierarchy}, bits={h: bits[h] for h in hierarchy},
                    rename={h: names[h] for h in hierarchy})
    out = out.withColumn("pct", pct_of("met_count", "n_size"))
    cols = [names[h] for h in hierarchy] + ["dimension", "n_size", "met_count", "pct"] + [bits[h] for h in hierarchy]
    return out.select(*cols)


def pso_report(code: str, record_kav: DataFrame, answers: DataFrame, attributes: Mapping[str, str], lookups: Mapping[str, DataFrame], **kw) -> DataFrame:
    """RP8-RP12 (AG18, FI14): the outcome rollup by the dimension of ``code``
    (D, E, G or R). Exit reasons keep unknown codes; disability and gender give
    NULL for them; race shows its raw code, as the source does."""
    if code not in DIMENSIONS:
        raise ValueError(f"unknown dimension code {code!r}; expected one of {sorted(DIMENSIONS)}")
    lookup = None if code == "R" else lookups.get(code)
    return pso_rollup(record_kav, answers, dimension_attr=attributes[code], lookup=lookup, fallback=code == "E", **kw)


def record_matrix(record_kav: DataFrame, attributes: Mapping[str, str] | None = None,
                  order: str = "instance_id", grants: DataFrame | None = None, user_id: str | None = None,
                  roster_year=None) -> DataFrame:
    """RP13: record attributes as a matrix, one row per AU x attribute with
    the first value (deterministically: of the smallest ``order`` key) and
    the number of records, of the user's organisations and the year."""
    rk = record_kav if attributes is None else record_kav.filter(F.col("attribute_id").isin(list(attributes)))
    if grants is not None and user_id is not None:
        rk = restrict_to_user(rk, grants, user_id)
    if roster_year is not None:
        rk = rk.filter(F.col("roster_year") == F.lit(roster_year))
    return rk.groupBy("au", "attribute_id").agg(
        first_ordered("value", order).alias("first_value"),
        F.count(F.lit(1)).alias("n_records"))


def record_matrix_by_instance(kav: DataFrame, attributes: DataFrame, submission_mode_id: str, record_set_id: str, roster_year_id: str,
                              grants: DataFrame, user_id: str) -> DataFrame:
    """RP13 (AG26): one row per submission sequence and instance of a mode, year and record set, of the user's organisations; a
    column per attribute, in the order of its sequence and name; a cell is the first value (by attribute id, then value).

    ``kav`` is ``views.record_kav``, ``attributes`` the native attribute table. Its rows of the record set are read when
    the plan is built: they are the report's columns, bounded by the record set's definition.
    """
    meta = attributes.filter(F.col("record_set_id") == F.lit(record_set_id)).select("sequence_number", "name").distinct().collect()
    heads = sorted({(r["sequence_number"], r["name"]) for r in meta}, key=lambda h: (h[0] is not None, h[0] or 0, h[1] or ""))
    names = safe_names(["submission_sequence", "instance_id", *[name or "" for _, name in heads]])[2:]
    rows = restrict_to_user(kav, grants, user_id).filter(
        (F.col("submission_mode_id") == F.lit(submission_mode_id)) & (F.col("record_set_id") == F.lit(record_set_id))
        & (F.col("roster_year_id") == F.lit(roster_year_id)))
    columns = {n: F.col("attribute_sequence").eqNullSafe(F.lit(k)) & F.col("attribute").eqNullSafe(F.lit(head))
               for n, (k, head) in zip(names, heads, strict=True)}
    return pivot_first(rows, ["submission_sequence", "instance_id"], columns, "value", F.struct("attribute_id", "value"))
