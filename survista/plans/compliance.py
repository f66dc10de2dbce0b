"""Compliance checklist reports (PL4 shape, RP1-RP7).

Inputs are answer detail rows - (instance_id, au, statement, value) joined
to statement metadata (section, sequences, is_note) - the shape the
checklist view produces. Measures are aggregated per (org x statement) or
(org x section) before any ranking, so windows see one row per statement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import eq_null_sentinel, ratio_half_up
from ..operators.filters import branch_flag, restrict_to_user
from ..operators.hierarchy import item_pct_of_sample, rollup_by
from ..operators.joins import not_in
from ..operators.measures import nonzero_mean, pct_met, yes_rate
from ..operators.ranking import rank_global, top_bottom
from ..operators.reshape import borrow_rows, union_sections
from ..operators.tree import flag_last

# Report labels and option labels of the checklist's answers.
MET, NOT_MET, NOT_APPLICABLE = "Met", "Not Met", "Not Applicable"
YES, NO = "Yes", "No"


def in_scope(detail: DataFrame, grants: DataFrame | None = None, user_id: str | None = None, roster_year=None) -> DataFrame:
    """The detail rows a report shows: of organisations granted to the user,
    of the roster year, and of records that are not excluded (where ``detail``
    has ``excluded``)."""
    d = detail.filter(~F.col("excluded")) if "excluded" in detail.columns else detail
    if grants is not None and user_id is not None:
        d = restrict_to_user(d, grants, user_id)
    return d if roster_year is None else d.filter(F.col("roster_year") == F.lit(roster_year))


def compliance_attributes(statements: DataFrame) -> DataFrame:
    """PL4 tail: statement metadata with ``is_note`` = last statement of its
    section (by sequence, then id)."""
    return flag_last(statements, "section_id", ["sequence", "attribute_id"], "is_note")


def compliance_2(detail: DataFrame, attrs: DataFrame, search_key: str | None = None,
                 key_col: str = "search_key") -> DataFrame:
    """RP1: checklist rows: section / statement / value / note flag, for one
    student (``search_key``; NULL keys match nothing) or for all when None."""
    d = detail if search_key is None else detail.filter(eq_null_sentinel(key_col, search_key))
    return d.join(attrs, "attribute_id").select(
        "instance_id", "section_id", "section", "section_sequence", "attribute_id", "sequence", "value", "is_note")


def compliance_2b(detail: DataFrame, attrs: DataFrame, search_key: str | None = None,
                  key_col: str = "search_key") -> DataFrame:
    """RP2: each non-note statement paired with its section's note answer.
    Statements = attributes NOT IN the note ids (NULL-aware); notes joined
    back on (instance, section). A statement whose section has no note answer
    drops out. Statements and notes are told apart by id on the form's side and
    paired by a window, so the answers are read once."""
    notes_ids = attrs.filter(F.col("is_note") == 1).select("attribute_id").distinct()
    stmts_ids = not_in(attrs.select("attribute_id").distinct(), notes_ids, "attribute_id")
    marked = (attrs.join(stmts_ids.withColumn("__stmt", F.lit(True)), "attribute_id", "left")
              .join(notes_ids.withColumn("__note", F.lit(True)), "attribute_id", "left"))
    d = detail if search_key is None else detail.filter(eq_null_sentinel(key_col, search_key))
    own = Window.partitionBy("instance_id", "section_id")
    notes = F.collect_list(F.when(F.col("__note"), F.struct(F.col("value").alias("note")))).over(own)
    rows = d.join(marked, "attribute_id").filter(F.col("instance_id").isNotNull() & F.col("section_id").isNotNull()).withColumn("__notes", notes)
    return (rows.filter(F.col("__stmt")).withColumn("__n", F.explode("__notes"))
            .select("instance_id", "section", "sequence", "attribute_id", "value", F.col("__n.note").alias("note")))


def compliance_3(detail: DataFrame, attrs: DataFrame, by: Sequence[str] = ("au",)) -> DataFrame:
    """RP3: percent Met of (Met + Not Met) per AU (and type of review, by
    ``by``) x section; a section with no
    'Met' gives NULL (not 0)."""
    d = detail.join(attrs, "attribute_id")
    v = F.col("value")
    return d.groupBy(*by, "section_sequence", "section").agg(
        pct_met(v == MET, v.isin(MET, NOT_MET)).alias("pct"))


def compliance_3_overall(section_pcts: DataFrame) -> DataFrame:
    """RP3 report group: mean of the section percents ignoring NULL and 0."""
    return section_pcts.groupBy("au").agg(nonzero_mean(F.col("pct")).alias("overall"))


def _yes_no(detail: DataFrame) -> DataFrame:
    """Yes and no by the option's label, not applicable by its report label
    (``value``), blank where no option was chosen."""
    label = F.col("label")
    return (detail.withColumn("yes", F.when(label == YES, 1).otherwise(0))
            .withColumn("no", F.when(label == NO, 1).otherwise(0))
            .withColumn("na", F.when(F.col("value") == NOT_APPLICABLE, 1).otherwise(0))
            .withColumn("blank", F.when(label.isNull(), 1).otherwise(0)))


def compliance_4(detail: DataFrame, attrs: DataFrame, section=None, borrow_attribute=None, borrow_section=None,
                 borrow_position: float = 99.0, overall_position: float = 3.5, when_section: str | None = None) -> DataFrame:
    """RP4: Yes / No / NA / Blank per statement per AU and State (rollup) of
    the chosen ``section`` (all sections when None); ``yes_rate`` =
    yes/(yes+no) else 0. Where the chosen section is ``borrow_section``, the
    statement ``borrow_attribute`` of another section is counted in it as well,
    at ``borrow_position``, and each org has an 'Overall' row of the section at
    ``overall_position``. With ``when_section`` these two depend on the chosen
    section's *name* instead, looked up when the query runs (FI12). Answers are
    summed to (au, statement) before they are borrowed, rolled up or totalled."""
    marks = ("yes", "no", "na", "blank")
    keys = ["section_id", "section", "section_sequence", "attribute_id", "position"]
    d = (_yes_no(detail.join(attrs, "attribute_id")).withColumn("position", F.col("sequence").cast("double"))
         .groupBy("au", *keys).agg(*[F.sum(c).alias(c) for c in marks]))
    gate: DataFrame | bool = borrow_attribute is not None and section is not None and section == borrow_section
    if when_section is not None:
        borrow_section = section
        gate = attrs.filter(F.col("section_id") == F.lit(section)).agg(F.max("section") == F.lit(when_section))
    if gate is not False:
        host = attrs.filter(F.col("section_id") == F.lit(borrow_section))
        d = d.withColumn("__here", branch_flag(gate))
        d = borrow_rows(d, F.col("__here") & (F.col("attribute_id") == F.lit(borrow_attribute)),
                        {"section_id": F.lit(borrow_section), "section": host.agg(F.max("section")).scalar(),
                         "section_sequence": host.agg(F.max("section_sequence")).scalar(),
                         "position": F.lit(float(borrow_position))})
    if section is not None:
        d = d.filter(F.col("section_id") == F.lit(section))
    if gate is not False:  # each row counts in its statement and in its section's overall row
        d = borrow_rows(d, F.col("__here"), {"attribute_id": F.lit(None), "position": F.lit(float(overall_position))})
    out = rollup_by(d, ["au"], ["section_sequence", "section", "attribute_id", "position"], [F.sum(c).cast("double").alias(c) for c in marks],
                    labels={"au": "State"}, bits={"au": "sort_bit"})
    return out.withColumn("yes_rate", yes_rate(F.col("yes"), F.col("no")))


def compliance_4_sample(detail: DataFrame, attrs: DataFrame) -> DataFrame:
    """RP5: per AU (and State) and statement: yes count (Met or Not
    Applicable) over the org's sample size of instances, decimal(5,1)."""
    d = detail.join(attrs, "attribute_id")
    d = d.withColumn("yes", F.when(F.col("value").isin(MET, NOT_APPLICABLE), 1).otherwise(0))
    return item_pct_of_sample(d, "au", "instance_id", ["section", "attribute_id", "sequence"], "yes").select(
        F.col("au").alias("admin_unit"), "section", "attribute_id", "sequence", "yes_count", "n_size",
        "item_pct", "sort_bit")


def compliance_8(detail: DataFrame, n: int = 5, statement: str = "attribute_id") -> DataFrame:
    """RP6: top-n and bottom-n statements overall by percent yes of yes+no
    (ties: yes count, then statement). Keeps the source's quirk of showing
    the *top* sort number on bottom rows as ``sort``, plus ``bottom_rank``."""
    d = _yes_no(detail)
    calc = d.groupBy(statement).agg(F.sum("yes").cast("long").alias("yes_count"),
                                    (F.sum("yes") + F.sum("no")).cast("long").alias("total"))
    calc = calc.filter(F.col("total") > 0).withColumn(
        "pct", ratio_half_up("yes_count", "total", scale=2, times=100).cast("decimal(5,1)"))
    ranked = rank_global(calc, [F.col("pct").desc(), F.col("yes_count").desc(), F.col(statement).asc()], "top_sort")
    ranked = rank_global(ranked, [F.col("pct").asc(), F.col("yes_count").asc(), F.col(statement).asc()], "bottom_rank")
    top = ranked.filter(F.col("top_sort") <= n).withColumn("position", F.lit("Top"))
    bottom = ranked.filter(F.col("bottom_rank") <= n).withColumn("position", F.lit("Bottom"))
    return top.unionByName(bottom).select("position", F.col("top_sort").cast("int").alias("sort"),
                                          F.col("bottom_rank").cast("int").alias("bottom_rank"),
                                          statement, "pct")


def compliance_8_section(detail: DataFrame, attrs: DataFrame, section_lists: Sequence[Sequence], n: int = 5) -> DataFrame:
    """RP7: within each listed section group (a 6-way UNION in the source,
    one ``isin`` scan here), the top-n and bottom-n statements by State-level
    percent of the sample."""
    d = union_sections(detail.join(attrs, "attribute_id"), "section_id", section_lists)
    d = d.withColumn("yes", F.when(F.col("value") == MET, 1).otherwise(0))
    state = item_pct_of_sample(d, "au", "instance_id", ["part", "attribute_id"], "yes", total_only=True)
    ranked = top_bottom(state, "part", "item_pct", n, tie=["attribute_id"], rank="sequence")
    return ranked.select("part", "position", F.col("sequence").cast("int").alias("sequence"), "attribute_id",
                         "yes_count", "n_size", "item_pct")


def section_totals(attrs: DataFrame) -> DataFrame:
    """AG22: statements of each section."""
    return attrs.groupBy("section_id", "section", "section_sequence").agg(F.count(F.lit(1)).alias("total"))


def instance_counts(detail: DataFrame, attrs: DataFrame) -> DataFrame:
    """AG23: per AU and instance the yes answers and the largest section's
    number of statements."""
    d = _yes_no(detail.join(attrs, "attribute_id")).join(section_totals(attrs).select("section_id", "total"), "section_id", "left")
    return d.groupBy("au", "instance_id").agg(F.sum("yes").cast("long").alias("yes_count"), F.max("total").alias("section_count"))
