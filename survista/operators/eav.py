"""Entity-attribute-value operators: typed answer decoding (JN5, PJ3), fixed
and metadata-driven pivots (RS2, RS3) and derived score rows (RS7)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text, col, flag_text, us_date

# Answer types and the text emitted for multi-select answers in
# the wide export.
TEXT, SINGLE_SELECT, DATE, FLAG, MULTI_SELECT = "Text", "SingleSelect", "Date", "Flag", "MultiSelect"
MULTI_SELECT_TEXT = "Multi-select data not pulled"


def attach_typed_values(values: DataFrame, text: DataFrame, select: DataFrame, options: DataFrame,
                        date: DataFrame, flag: DataFrame, value_id: str = "id") -> DataFrame:
    """JN5: left-join the four typed side tables (same id as the value row).

    Adds ``text_value``, ``selected_option_id``, ``option_label``,
    ``option_report_label``, ``option_sequence``, ``date_value``, ``flag_value``.
    Each side table holds at most one row per value id, so the joins never fan
    out. They follow each other on the value id: one exchange a table, or none
    where the tables are bucketed by it (``sources.persist``). The options, a
    table as large as the forms, come last.
    """
    v = values
    for side, columns in ((text, {"value": "text_value"}), (select, {"selected_option_id": "selected_option_id"}),
                          (date, {"value": "date_value"}), (flag, {"value": "flag_value"})):
        own = side.select(F.col("id").alias("__side"), *[F.col(c).alias(n) for c, n in columns.items()])
        v = v.join(own, F.col(value_id) == F.col("__side"), "left").drop("__side")
    opt = options.select(F.col("id").alias("__o"), F.col("label").alias("option_label"),
                         F.col("report_label").alias("option_report_label"),
                         F.col("sequence").alias("option_sequence"))
    return v.join(opt, F.col("selected_option_id") == F.col("__o"), "left").drop("__o")


def decode_value(item_type: str | Column, policy: str = "report_label") -> Column:
    """PJ3: one text value per answer, chosen by the item's type.

    ``policy='report_label'``: options show ``coalesce(report_label, label)``,
    other types NULL except text/date/flag (the formlet view).
    ``policy='label'``: options show ``label`` (checklist reports).
    ``policy='export'``: the wide export: cleaned text, MM/dd/yyyy dates,
    '1'/'0' flags, option labels, a fixed text for multi-selects, and an
    error for any other type (the export refuses unknown types on purpose).
    """
    t = col(item_type)
    if policy == "report_label":
        opt = F.coalesce(F.col("option_report_label"), F.col("option_label"))
    else:
        opt = F.col("option_label")
    text = clean_text("text_value") if policy == "export" else F.col("text_value")
    expr = (F.when(t == TEXT, text)
            .when(t == SINGLE_SELECT, opt)
            .when(t == DATE, us_date("date_value"))
            .when(t == FLAG, flag_text("flag_value")))
    if policy == "export":
        expr = expr.when(t == MULTI_SELECT, F.lit(MULTI_SELECT_TEXT)).otherwise(
            F.raise_error(F.concat(F.lit("unhandled input item type: "), F.coalesce(t, F.lit("NULL")))))
    return expr


def pivot_attributes(df: DataFrame, keys: Sequence[str], attributes: Mapping[str, str],
                     attribute: str = "attribute_id", value: str | Column = "value",
                     values: Mapping[str, Column] | None = None, default=None) -> DataFrame:
    """RS2: fixed EAV -> wide pivot, ``max(case when attribute = id then value end)``.

    ``attributes`` maps attribute id -> output column name; ``values`` may give
    a per-attribute value expression (a decoded column). One aggregate on
    ``keys`` (Spark sorts for the string ``max``) with map-side partial aggregation, so a hot key is pre-combined
    before the shuffle. ``default`` fills cells with no value (RS6 uses '').
    """
    aggs = []
    for attr_id, name in attributes.items():
        v = (values or {}).get(attr_id, col(value))
        cell = F.max(F.when(F.col(attribute) == F.lit(attr_id), v))
        if default is not None:
            cell = F.coalesce(cell, F.lit(default))
        aggs.append(cell.alias(name))
    return df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()


_BAD = re.compile(r"[^0-9A-Za-z_]+")


def safe_names(names: Sequence[str], fallbacks: Sequence[str] | None = None) -> list[str]:
    """Column names from metadata labels: sanitised, non-empty and unique."""
    out, seen = [], set()
    for i, n in enumerate(names):
        base = _BAD.sub("_", (n or "").strip()).strip("_")
        if not base and fallbacks:
            base = _BAD.sub("_", fallbacks[i] or "").strip("_")
        base = base or f"col_{i + 1}"
        name, k = base, 1
        while name.lower() in seen:
            k += 1
            name = f"{base}_{k}"
        seen.add(name.lower())
        out.append(name)
    return out


def pivot_from_metadata(df: DataFrame, meta: DataFrame, keys: Sequence[str], attribute: str = "attribute_id",
                        value: str | Column = "value", meta_id: str = "attribute_id",
                        meta_name: str = "attribute", meta_order: Sequence[str] = ("attribute_sequence",),
                        meta_type: str | None = None, cell_by_type: Mapping[str, Column] | None = None) -> DataFrame:
    """RS3: metadata-driven dynamic pivot.

    Phase 1 (driver): read the attribute metadata - one row per attribute,
    bounded by the form definition, not by the data. Phase 2 (cluster): one aggregate with a generated
    ``max(case when ...)`` per attribute; cell expressions can depend on the
    attribute's type. This replaces the dynamic-SQL string building.
    """
    cols = [meta_id, meta_name] + ([meta_type] if meta_type else [])
    rows = meta.select(*cols, *meta_order).distinct().orderBy(*meta_order, meta_id).collect()
    names = safe_names([r[meta_name] for r in rows], [r[meta_id] for r in rows])
    aggs = []
    for r, name in zip(rows, names):
        v = col(value)
        if meta_type and cell_by_type is not None:
            t = r[meta_type]
            if t not in cell_by_type:
                raise ValueError(f"unhandled attribute type {t!r} for {r[meta_id]}")
            v = cell_by_type[t]
        aggs.append(F.max(F.when(F.col(attribute) == F.lit(r[meta_id]), v)).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def emit_scores(df: DataFrame, code: str = "attribute_code", report_label: str = "attribute_report_label",
                label: str = "attribute_label", item_type: str = "input_item_type",
                display_sequence: str = "display_sequence", value: str = "value",
                option_sequence: str = "value_sequence", weight: str = "report_weight",
                value_text=None) -> DataFrame:
    """RS7: each answer row once as is, plus - when the item has a report
    weight - a Likert row (option sequence + 1) and a weighted row
    ((sequence + 1) * weight). One scan and one ``explode`` instead of three
    scans + UNION ALL. Adds ``weighted`` (NULL / false / true)."""
    scored = F.col(weight).isNotNull()
    seq1 = F.col(option_sequence) + F.lit(1)
    as_text = value_text or (lambda c: c.cast("string"))

    def variant(kind: int) -> Column:
        if kind == 0:
            return F.struct(F.col(code).alias("c"), F.col(report_label).alias("rl"), F.col(label).alias("l"),
                            F.col(item_type).alias("t"), F.col(display_sequence).alias("ds"),
                            F.col(value).cast("string").alias("v"), F.lit(None).cast("boolean").alias("w"))
        prefix, text, ds = ("L", "Likert Score ", "B") if kind == 1 else ("W", "Weighted Score ", "C")
        v = seq1 if kind == 1 else seq1 * F.col(weight)
        return F.struct(F.concat(F.lit(prefix), F.col(code)).alias("c"),
                        F.concat(F.lit(text), F.col(code)).alias("rl"),
                        F.concat(F.lit(text), F.col(code)).alias("l"),
                        F.lit("Derived").alias("t"),
                        F.concat(F.lit(ds), F.col(display_sequence)).alias("ds"),
                        (v.cast("string") if kind == 1 else as_text(v)).alias("v"), F.lit(kind == 2).alias("w"))

    variants = F.when(scored, F.array(variant(0), variant(1), variant(2))).otherwise(F.array(variant(0)))
    keep = [c for c in df.columns if c not in {code, report_label, label, item_type, display_sequence, value}]
    return (df.select(*keep, F.explode(variants).alias("__r"))
            .select(*keep, F.col("__r.c").alias(code), F.col("__r.rl").alias(report_label),
                    F.col("__r.l").alias(label), F.col("__r.t").alias(item_type),
                    F.col("__r.ds").alias(display_sequence), F.col("__r.v").alias(value),
                    F.col("__r.w").alias("weighted")))
