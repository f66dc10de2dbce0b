"""Submission tracking with gaps shown (RP20 long form, RP21 wide form).

Facts are aggregated or keyed to (org x year x mode) first; the skeleton of
every org x year x mode comes from the dimension values (see
``operators.densify``) and the facts are left-joined onto it, so combinations
without submissions still appear.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import KEEP, any_of, contains_ci, map_values, roster_year_label, us_date
from ..operators.densify import densify, skeleton
from ..operators.eav import safe_names
from ..operators.filters import active, drop_in, restrict_to_user
from ..operators.reshape import unpivot_facts, wide_crosstab
from ..operators.tree import sequence_by_expr
from .views import form_items

# The first attribute of the report and its label.
SUBMISSION_DATE, DATE_LABEL = "SubmissionDate", "Date of Submission"


def mode_sequence(modes: DataFrame, mode: str = "mode", rename: Mapping[str, str] | None = None,
                  exclude: Sequence[str] = ()) -> DataFrame:
    """Modes shown (FI2) with their number by name, some renamed for the order
    only (WN8). One row per mode of the form definition."""
    shown = drop_in(modes.select(mode).distinct(), mode, list(exclude)) if exclude else modes.select(mode).distinct()
    return sequence_by_expr(shown, [map_values(mode, rename or {}, KEEP)], "mode_sequence")


def help_attributes(attributes: DataFrame, text: str = "assistance", review_mode=None, review_codes: Sequence[str] = ()) -> DataFrame:
    """Attributes (mode, code, label, item_type) that ask for help (FI9), or
    are review dates of one mode (FI10)."""
    cond = contains_ci("label", text)
    if review_mode is not None:
        cond = any_of(cond, (F.col("mode") == F.lit(review_mode)) & (F.col("item_type") == "Date") & F.col("code").isin(list(review_codes)))
    return attributes.filter(cond)


def gifted_long(submissions: DataFrame, orgs: DataFrame, years: DataFrame, modes: DataFrame, attributes: DataFrame, answers: DataFrame,
                grants: DataFrame | None = None, user_id: str | None = None) -> DataFrame:
    """RP20: per org x year x mode a row with the last submission date (MM/dd/
    yyyy text, the maximum taken on the text as the source does), then a row
    per help attribute of the mode and answer; gaps show NULL.

    submissions: org_unit_id, roster_year, mode, started_date. orgs:
    org_unit_id, au. modes: mode, mode_sequence. attributes: mode, code, label.
    answers: org_unit_id, roster_year, mode, code, value.
    """
    shown = orgs.select("org_unit_id", "au").distinct()
    if grants is not None and user_id is not None:
        shown = restrict_to_user(shown, grants, user_id)
    skel = skeleton(shown, {"roster_year": years, "mode": modes.select("mode")}).join(modes, "mode")
    dates = submissions.groupBy("org_unit_id", "roster_year", "mode").agg(F.max(us_date("started_date")).alias("value"))
    keys = ["org_unit_id", "roster_year", "mode"]
    first = densify(skel, dates, keys).withColumns({
        "attribute": F.lit(SUBMISSION_DATE), "attribute_sequence": F.lit(0), "input_item_label": F.lit(DATE_LABEL)})
    asked = skel.join(attributes.select("mode", F.col("code").alias("attribute"), F.col("label").alias("input_item_label")), "mode")
    more = asked.join(answers.select(*keys, F.col("code").alias("attribute"), "value"), [*keys, "attribute"], "left").withColumn("attribute_sequence", F.lit(1))
    cols = ["au", "roster_year", "mode", "mode_sequence", "attribute", "attribute_sequence", "input_item_label", "value"]
    return first.select(*cols).unionByName(more.select(*cols))


def gifted_wide(long: DataFrame, modes: Sequence[str], attributes: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """RP21: one row per org x year; for each mode a column with its submission
    date and one for each help attribute, '' for gaps."""
    names = names or [str(m) for m in modes]
    cols = {}
    for m, n in zip(modes, names, strict=True):
        for a in (SUBMISSION_DATE, *attributes):
            cols[f"{n}_{'submitted' if a == SUBMISSION_DATE else a.lower()}"] = F.when((F.col("mode") == F.lit(m)) & (F.col("attribute") == F.lit(a)), F.col("value"))
    return wide_crosstab(long, ["au", "roster_year"], cols, default="")


# -- over the native store --------------------------------------------------------------
# The mode that sorts under another name, organisations that are tests, the review codes with the names shown for
# them and the item labels they are found by.
MODE_ORDER = {"Annual Budget Review": "AU Budget: Review"}
TEST_ORGS = ["TEST", "TEST AU", "SAML TEST - Douglas RE-1 Castle Rock"]
REVIEWS = {"Rev1": "4 Month", "Rev2": "8 Month"}
REVIEW_LABELS = {"4 Month": "Review Date 1 (4 months after submission):", "8 Month": "Review Date 2 (8 months after submission):"}
DUE, SUBMITTED, HELP = "Due Date", "Date Submitted", "HELP?"


def _a(df: DataFrame, prefix: str, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def program_modes(t: dict[str, DataFrame], program_id: str, excluded: Sequence[str] = ()) -> DataFrame:
    """WN8: the submission modes of a program with their location and number: by location, type and name, one mode under
    another name."""
    loc = t["mon_location"].filter(F.col("program_id") == F.lit(program_id)).select(
        F.col("id").alias("location_id"), F.col("display_name").alias("location"), F.col("sequence").alias("location_sequence"))
    types = t["mon_submission_type"].select(F.col("id").alias("submission_type_id"), F.col("name").alias("submission_type"), "location_id", "form_template_id")
    modes = t["mon_submission_mode"].select(F.col("id").alias("submission_mode_id"), F.col("name").alias("submission_mode"), "submission_type_id")
    shown = loc.join(types, "location_id").join(drop_in(modes, "submission_mode_id", list(excluded)) if excluded else modes, "submission_type_id")
    order = [F.col("location_sequence"), F.col("submission_type"), map_values("submission_mode", MODE_ORDER, KEEP), F.col("submission_mode_id")]
    return sequence_by_expr(shown, order, "mode_sequence")


def asking_items(t: dict[str, DataFrame], modes: DataFrame, review_mode: str | None = None, text: str = "assistance") -> DataFrame:
    """FI9, FI10: the items of the modes' forms that ask for help, and the review dates of one mode; a mode without any has
    no row."""
    items = form_items(t).filter(F.col("layout_parent_id").isNotNull()).select(
        F.col("template_id").alias("form_template_id"), "attribute_id", F.col("attribute_code").alias("code"),
        F.col("attribute_label").alias("input_item_label"), "input_item_type")
    asks = any_of(contains_ci("input_item_label", text), (F.col("submission_mode_id") == F.lit(review_mode)) & (F.col("input_item_type") == "Date")
                  & F.col("code").isin(list(REVIEWS)))
    return items.join(modes, "form_template_id").filter(asks)


def tracked_rows(t: dict[str, DataFrame], program_id: str, user_id: str, excluded: Sequence[str] = (), review_mode: str | None = None) -> DataFrame:
    """What both forms of the report read: for each organisation of the user and year with live submissions of the program, and
    each asking item of each mode, the submission's dates and the option chosen on each of its forms; gaps are rows of NULLs (JN14)."""
    modes = program_modes(t, program_id, excluded)
    asked = asking_items(t, modes, review_mode)
    # A type without a mode (or with excluded ones only) has no submissions here.
    subs = active(t["mon_submissions"]).join(modes.select("submission_type_id").distinct(), "submission_type_id", "left_semi")
    orgs = drop_in(t["org_unit"].select(F.col("id").alias("org_unit_id"), F.col("name").alias("au")), "au", TEST_ORGS)
    shown = restrict_to_user(subs.select("org_unit_id").distinct().join(orgs, "org_unit_id"), t["user_profile_org_unit"], user_id)
    years = subs.select(F.col("roster_year_id")).distinct().join(_a(t["roster_year"], "ry_", "id", "start_year"), F.col("roster_year_id") == F.col("ry_id"))
    item = F.struct(*[F.col(c) for c in ("location_sequence", "location", "submission_mode", "submission_mode_id", "mode_sequence", "attribute_id", "code",
                                         "input_item_label")])
    year = F.struct("roster_year_id", roster_year_label("ry_start_year", "-").alias("roster_year"))
    skel = skeleton(shown, {"__year": years.select(year.alias("y")), "__item": asked.select(item.alias("i"))}).select("org_unit_id", "au", "__year.*", "__item.*")
    live = active(t["mon_submissions"]).select(F.col("id").alias("s_id"), "org_unit_id", "roster_year_id", "submission_mode_id", "started_date", "closed_date")
    forms = (_a(t["mon_submission_record"], "sr_", "id", "submissions_id")
             .join(_a(t["mon_submission_record_form"], "rf_", "id", "submission_record_id"), F.col("sr_id") == F.col("rf_submission_record_id"), "left")
             .join(_a(t["form_instance"], "fi_", "id"), F.col("rf_id") == F.col("fi_id"), "left")
             .join(_a(t["form_instance_interval"], "fii_", "id", "instance_id"), F.col("fi_id") == F.col("fii_instance_id"), "left"))
    # The asking items are few (the skeleton holds them as an array); an exchange by item would put an item's answers in one task.
    chosen = (_a(t["form_input_value"], "v_", "id", "interval_id", "input_field_id")
              .join(F.broadcast(asked.select(F.col("attribute_id").alias("v_input_field_id")).distinct()), "v_input_field_id", "left_semi")
              .join(_a(t["form_input_single_select_value"], "ss_", "id", "selected_option_id"), F.col("v_id") == F.col("ss_id"), "left")
              .join(_a(t["form_template_input_select_field_option"], "o_", "id", "label"), F.col("ss_selected_option_id") == F.col("o_id"), "left"))
    return (densify(skel, live, ["org_unit_id", "roster_year_id", "submission_mode_id"])
            .join(forms, F.col("s_id") == F.col("sr_submissions_id"), "left")
            .join(chosen, (F.col("fii_id") == F.col("v_interval_id")) & (F.col("attribute_id") == F.col("v_input_field_id")), "left")
            .select("au", "roster_year", "location", "location_sequence", "submission_mode", "submission_mode_id", "mode_sequence", "attribute_id", "code",
                    "input_item_label", "started_date", "closed_date", F.col("o_label").alias("label")))


def tracked_long(t: dict[str, DataFrame], program_id: str, user_id: str, excluded: Sequence[str] = (), review_mode: str | None = None) -> DataFrame:
    """RP20: a row per organisation, year and asking mode with the submission date (the largest as text, as in the source),
    and a row for each answer to an asking item; review items show under the names of their months. The source shows the
    option chosen, so an answer of another type shows NULL."""
    rows = tracked_rows(t, program_id, user_id, excluded, review_mode)
    keys = ["au", "roster_year", "location", "submission_mode", "submission_mode_id", "mode_sequence"]
    first = rows.groupBy(*keys).agg(F.max(us_date("started_date")).alias("value")).withColumns({
        "attribute": F.lit(SUBMISSION_DATE), "attribute_sequence": F.lit(0), "input_item_label": F.lit(DATE_LABEL)})
    more = rows.withColumns({"submission_mode": F.coalesce(map_values("code", REVIEWS), "submission_mode"), "attribute": F.col("code"),
                             "attribute_sequence": F.lit(1), "value": F.col("label")})
    cols = [*keys, "attribute", "attribute_sequence", "input_item_label", "value"]
    return first.select(*cols).unionByName(more.select(*cols))


def tracked_wide(t: dict[str, DataFrame], program_id: str, user_id: str, excluded: Sequence[str] = (), review_mode: str | None = None) -> DataFrame:
    """RP21 (RS8, RS6): one row per organisation and year; for each mode of the program its due date (the start of the
    submission), the date submitted (its close) and the largest help answer, and for the review mode its months; '' for
    gaps. The columns come from the modes, which are read when the plan is built; dates and answers are unpivoted once."""
    modes = program_modes(t, program_id, excluded).select("location_sequence", "location", "submission_mode", "submission_mode_id", "mode_sequence").collect()
    columns = {}
    for m in sorted(modes, key=lambda m: m["mode_sequence"]):
        here = F.col("submission_mode_id") == F.lit(m["submission_mode_id"])
        parts = {k: here & (F.col("part") == F.lit(k)) for k in (DUE, SUBMITTED, HELP)}
        if m["submission_mode_id"] == review_mode:
            parts |= {name: here & (F.col("part") == HELP) & (F.col("input_item_label") == F.lit(label)) for name, label in REVIEW_LABELS.items()}
        columns |= {f"{m['location']} - {m['submission_mode']} {k}": F.when(c, F.col("value")) for k, c in parts.items()}
    names = safe_names(["au", "roster_year", *columns])[2:]
    rows = tracked_rows(t, program_id, user_id, excluded, review_mode)
    long = unpivot_facts(rows, ["au", "roster_year", "submission_mode_id", "input_item_label"],
                         {DUE: us_date("started_date"), SUBMITTED: us_date("closed_date"), HELP: F.col("label")}, label="part")
    return wide_crosstab(long, ["au", "roster_year"], dict(zip(names, columns.values(), strict=True)), default="")
