"""The family survey over the native store (PL5, PL6), with its reports' input shape.

The answers are read once: one exchange by instance, after which windows give each instance its language, its match, the
all-blank test and the count behind the Likert75 flag. Record attributes are read from EAV rows in one aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import KEEP, likert, map_values, merge_buckets, roster_year_label
from ..operators.eav import pivot_attributes
from ..operators.filters import active, drop_in
from ..operators.measures import count_where, threshold_flag
from ..operators.tree import sequence

BLANK = "Blank"
# Layout positions of the language, the disability match and the questions in the survey's form.
LANGUAGE_AT, MATCH_AT, QUESTIONS_AT = 0, 2, 4
# Short names of the disability codes.
DISABILITIES = {"01": "ID", "03": "SED", "04": "SLD", "05": "HI", "06": "VI", "07": "PD", "08": "SLI", "09": "DB", "10": "MD", "11": "DD",
                "12": "IT", "13": "Aut", "14": "TBI", "15": "OI", "16": "OHI"}


def _a(df: DataFrame, prefix: str, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def _live(t: dict[str, DataFrame], submission_type_id: str, outside: Sequence[str]) -> DataFrame:
    subs = active(t["mon_submissions"]).filter(F.col("submission_type_id") == F.lit(submission_type_id))
    return _a(drop_in(subs, "submission_mode_id", list(outside)) if outside else subs, "s_", "id", "org_unit_id", "roster_year_id")


def submissions(t: dict[str, DataFrame], submission_type_id: str, attributes: Mapping[str, str], outside: Sequence[str] = ()) -> DataFrame:
    """PL5: one row per form instance of the survey's live submissions, those of the ``outside`` modes and of excluded
    records left out. ``attributes``: attribute ids of district, school, disability and grade; a record without one shows
    'Blank'. Submissions (a row per organisation, year and mode, not per record) are broadcast with their organisation and year."""
    subs = (_live(t, submission_type_id, outside)
            .join(_a(t["org_unit"], "ou_", "id", "name"), F.col("s_org_unit_id") == F.col("ou_id"), "left")
            .join(_a(t["roster_year"], "ry_", "id", "start_year"), F.col("s_roster_year_id") == F.col("ry_id"), "left"))
    own = t["mon_record_attribute_value"].filter(F.col("attribute_id").isin(list(attributes.values())))
    wide = pivot_attributes(own, ["record_id"], {i: f"v_{n}" for n, i in attributes.items()})
    d = (_a(t["mon_submission_record"], "sr_", "id", "submissions_id", "record_selection_id")
         .join(F.broadcast(subs), F.col("sr_submissions_id") == F.col("s_id"))
         .join(_a(t["mon_submission_record_form"], "rf_", "id", "submission_record_id"), F.col("rf_submission_record_id") == F.col("sr_id"))
         .join(_a(t["mon_record_selection"], "sel_", "id", "record_id", "excluded_date"), F.col("sr_record_selection_id") == F.col("sel_id"), "left")
         .filter(F.col("sel_excluded_date").isNull())
         .join(wide, F.col("sel_record_id") == F.col("record_id"), "left")
         .join(_a(t["mon_record"], "m_", "id", "search_key"), F.col("sel_record_id") == F.col("m_id"), "left"))
    shown = {n: F.coalesce(f"v_{n}", F.lit(BLANK)) for n in attributes}
    return d.select(F.col("rf_id").alias("instance_id"), F.col("ou_id").alias("org_unit_id"), F.col("ry_id").alias("roster_year_id"),
                    roster_year_label("ry_start_year", "-").alias("roster_year"), F.col("ou_name").alias("au"),
                    *[c.alias(n) for n, c in shown.items()], map_values(shown["disability"], DISABILITIES, KEEP).alias("disab"),
                    F.col("m_search_key").alias("search_key"))


def _form(t: dict[str, DataFrame], template_id: str, dropped: Sequence[str]) -> DataFrame:
    """The items of the form with their place in the layout, an item that has several rows numbered."""
    layout = t["form_template_layout"].filter(F.col("template_id") == F.lit(template_id)).select("control_id", F.col("sequence").alias("layout_sequence"))
    items = _a(t["form_template_input_item"], "i_", "id", "input_area_id", "sequence", "code", "label", "report_label", "report_weight")
    items = (drop_in(items, "i_id", list(dropped)) if dropped else items).join(layout, F.col("i_input_area_id") == F.col("control_id"))
    rest = [c for c in items.columns if c not in ("i_id", "i_input_area_id", "control_id")]
    return sequence(items.select("i_id", *rest), "i_id", rest, "i_row")


def _read(t: dict[str, DataFrame], form: DataFrame, instances: DataFrame | None = None, value_id: Column | None = None,
          dropped: Sequence[str] = ()) -> DataFrame:
    """Every answer to an item of the form (of the ``instances``, if given): ids alone, as what is exchanged stays narrow, and
    ``_scored`` and ``_described`` add the rest. Answers meet their options' ids first: of the value ids, the widest column, only
    ``value_id`` goes on to the exchanges by interval and instance. The form's own rows are broadcast; ``dropped`` items are not
    among them, and said once more their answers go before they are dealt."""
    interval = _a(t["form_instance_interval"], "fii_", "id", "instance_id")
    if instances is not None:
        interval = interval.join(instances, F.col("fii_instance_id") == F.col("instance_id"), "left_semi")
    values = _a(t["form_input_value"], "v_", "id", "interval_id", "input_field_id")
    d = ((drop_in(values, "v_input_field_id", list(dropped)) if dropped else values)
         .join(F.broadcast(form.select("i_id", "i_row", "layout_sequence")), F.col("v_input_field_id") == F.col("i_id"))
         .join(_a(t["form_input_single_select_value"], "ss_", "id", "selected_option_id"), F.col("v_id") == F.col("ss_id"), "left"))
    d = d.select("v_interval_id", (F.col("v_id") if value_id is None else value_id).alias("value_id"), F.col("i_id").alias("attribute_id"), "i_row",
                 F.col("ss_selected_option_id").alias("option_id"))
    return d.join(interval, F.col("v_interval_id") == F.col("fii_id")).select(F.col("fii_instance_id").alias("instance_id"), *d.columns[1:])


def _scored(a: DataFrame, t: dict[str, DataFrame], form: DataFrame) -> DataFrame:
    """Answers with their place in the layout, their response and its score."""
    places = F.broadcast(form.select(F.col("i_id").alias("attribute_id"), "i_row", "layout_sequence", F.col("i_report_weight").isNotNull().alias("__scored")))
    options = t["form_template_input_select_field_option"].filter(F.col("deleted_date").isNull())
    a = (a.join(places, ["attribute_id", "i_row"])
         .join(_a(options, "o_", "id", "label", "sequence"), F.col("option_id") == F.col("o_id"), "left"))
    return a.select("instance_id", "value_id", "layout_sequence", "attribute_id", "i_row", F.col("o_label").alias("response"),
                    F.when(F.col("__scored"), likert("o_sequence")).alias("likert_score"))


def _described(a: DataFrame, form: DataFrame) -> DataFrame:
    """Answers with the texts of their items: the form's own rows, which the reports show as columns, so they are broadcast."""
    texts = F.broadcast(form.select(
        F.col("i_id").alias("attribute_id"), "i_row", (F.col("i_sequence") + 1).alias("question"), F.col("i_code").alias("question_code"),
        F.col("i_label").alias("question_text"), F.col("i_report_label").alias("question_report_label"), F.col("i_report_weight").alias("response_weight")))
    return a.join(texts, ["attribute_id", "i_row"]).drop("i_row")


def answers(t: dict[str, DataFrame], template_id: str, dropped: Sequence[str] = ()) -> DataFrame:
    """Every answer of the form, with its item, its place in the layout and its scores; an answer without a live option has a
    NULL response. ``dropped`` items are never read."""
    form = _form(t, template_id, dropped)
    return _described(_scored(_read(t, form, dropped=dropped), t, form), form)


def _answered(ignored: str | None):
    """Whether a row's instance stays: not if it has answers beside those to the ``ignored`` item and all of them are blank."""
    own = Window.partitionBy("instance_id")
    counted = F.col("attribute_id") != F.lit(ignored) if ignored is not None else F.lit(True)
    return (count_where(counted).over(own) == 0) | (count_where(counted & F.col("response").isNotNull()).over(own) > 0)


def responses(t: dict[str, DataFrame], template_id: str, dropped: Sequence[str] = (), ignored: str | None = None) -> DataFrame:
    """PL5: the answers of instances that are not all blank, the answer to the ``ignored`` item not counting."""
    form = _form(t, template_id, dropped)
    a = _described(_scored(_read(t, form, dropped=dropped), t, form).withColumn("__stays", _answered(ignored)).filter("__stays").drop("__stays"), form)
    return a.select("instance_id", "layout_sequence", "attribute_id", F.col("question").alias("item_sequence"), F.col("question_code").alias("code"),
                    F.col("question_text").alias("label"), F.coalesce("response", F.lit(BLANK)).alias("response"), "likert_score",
                    F.col("response_weight").alias("report_weight"))


def master(t: dict[str, DataFrame], submission_type_id: str, template_id: str, attributes: Mapping[str, str], outside: Sequence[str] = (),
           dropped: Sequence[str] = (), ignored: str | None = None, likert75_min: int = 12, one_row: bool = False) -> DataFrame:
    """PL6: submissions left-joined to their question answers; language and match are the instance's own answers at other
    places of the form ('Blank' without one, and a row for each where there are several); ``likert75`` is 1 on every row of an
    instance with at least ``likert75_min`` rows above 3. An instance without question answers shows a row for its first value,
    again where that value comes again; with ``one_row`` always one, for which no value id is exchanged (reports that sum over
    the questions show the same)."""
    own = Window.partitionBy("instance_id")
    asked = F.col("layout_sequence") == QUESTIONS_AT

    def side(at: int):
        return F.collect_list(F.when(F.col("layout_sequence") == at, F.coalesce("response", F.lit(BLANK)))).over(own)

    form = _form(t, template_id, dropped)
    # Only the answers of live submissions' instances are exchanged (``submissions`` leaves out more, of excluded records).
    kept = (_a(t["mon_submission_record_form"], "rf_", "id", "submission_record_id")
            .join(_a(t["mon_submission_record"], "sr_", "id", "submissions_id"), F.col("rf_submission_record_id") == F.col("sr_id"))
            .join(F.broadcast(_live(t, submission_type_id, outside)), F.col("sr_submissions_id") == F.col("s_id"), "left_semi")
            .select(F.col("rf_id").alias("instance_id")))
    # They are dealt by instance as ids, before places, labels and scores are looked up.
    if one_row:  # answers to the ignored item decide nothing, unless they are shown
        read = form.filter((F.col("i_id") != F.lit(ignored)) | F.col("layout_sequence").isin(LANGUAGE_AT, MATCH_AT, QUESTIONS_AT)) if ignored is not None else form
        a = _read(t, read, kept, F.lit(None).cast("string"), dropped)
        first = F.row_number().over(own.orderBy(F.lit(0))) == 1
    else:  # value ids only tell which row of an instance without question answers stays, so those of other rows are not exchanged
        a = _read(t, form, kept, F.when(asked, None).otherwise(F.col("v_id")), dropped)
        first = F.min("value_id").over(own) == F.col("value_id")
    a = _scored(a.repartition("instance_id"), t, form).withColumns({
        "__stays": _answered(ignored), "__languages": side(LANGUAGE_AT), "__matches": side(MATCH_AT), "__asked": count_where(asked).over(own), "__first": first})
    # An instance without question answers keeps one row for its language and match.
    a = _described(a.filter(F.col("__stays") & (asked | ((F.col("__asked") == 0) & F.col("__first")))), form)
    shown = [F.when(asked, F.col(c)).alias(c) for c in ("attribute_id", "question", "question_code", "question_text", "question_report_label",
                                                        "likert_score", "response_weight")]
    response = F.when(asked, F.coalesce("response", F.lit(BLANK))).alias("response")
    a = a.select("instance_id", *shown, response, "__languages", "__matches")
    d = submissions(t, submission_type_id, attributes, outside).join(a, "instance_id", "left")
    d = d.withColumn("grade", merge_buckets("grade", [["006", "007"]]))
    d = d.select("*", F.explode_outer("__languages").alias("__language")).select("*", F.explode_outer("__matches").alias("__match"))
    d = threshold_flag(d, "instance_id", F.col("likert_score") > 3, likert75_min, "likert75")
    return d.withColumns({"language": F.coalesce("__language", F.lit(BLANK)), "disability_match": F.coalesce("__match", F.lit(BLANK)),
                          "weighted_score": F.col("likert_score") * F.col("response_weight"),
                          "likert_gt3": F.when(F.col("likert_score") > 3, "Likert 4 or 5").otherwise("")}).drop(
        "__languages", "__matches", "__language", "__match")
