"""Reusable views over the native form / record store (PL1-PL4, PL7).

``t`` is the dict of native tables from ``sources.load``. Every view is a
lazy DataFrame: the report that uses it decides which columns and rows are
read, and Catalyst prunes the rest down to the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import float_text, roster_year_label
from ..operators.eav import SINGLE_SELECT, attach_typed_values, decode_value, emit_scores, pivot_attributes, safe_names
from ..operators.filters import active, restrict_to_user
from ..operators.joins import join_left_residual
from ..operators.tree import flag_last, flatten_tree, sequence
from ..sources.tables import persist


def _a(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def record_kav(t: dict[str, DataFrame]) -> DataFrame:
    """PL3: record attributes as key/attribute/value rows per submission
    record, for live submissions (not deleted, not a reliability check) and
    records not excluded."""
    subs = active(t["mon_submissions"])
    rec = t["mon_submission_record"]
    srf = _a(t["mon_submission_record_form"], "srf_", ["id", "submission_record_id"])
    sel = _a(t["mon_record_selection"], "sel_", ["id", "record_id", "excluded_date"])
    ou = _a(t["org_unit"], "ou_", ["id", "name", "number"])
    val = _a(t["mon_record_attribute_value"], "v_", ["record_id", "attribute_id", "value"])
    att = _a(t["mon_record_attribute"], "a_", ["id", "name", "record_set_id", "sequence_number"])
    mode = _a(t["mon_submission_mode"], "m_", ["id", "name"])
    st = _a(t["mon_submission_type"], "st_", ["id", "name", "location_id", "form_template_id"])
    loc = _a(t["mon_location"], "l_", ["id", "display_name"])
    rs = _a(t["mon_record_set"], "rs_", ["id", "name"])
    ry = _a(t["roster_year"], "ry_", ["id", "start_year"])
    d = (subs.join(rec, subs.id == rec.submissions_id)
         .join(srf, F.col("srf_submission_record_id") == rec.id, "left")
         .join(sel, F.col("sel_id") == rec.record_selection_id, "left")
         .filter(F.col("sel_excluded_date").isNull())
         .join(ou, F.col("ou_id") == subs.org_unit_id, "left")
         .join(val, F.col("v_record_id") == F.col("sel_record_id"), "left")
         .join(att, F.col("a_id") == F.col("v_attribute_id"), "left")
         .join(mode, F.col("m_id") == subs.submission_mode_id, "left")
         .join(st, F.col("st_id") == subs.submission_type_id, "left")
         .join(loc, F.col("l_id") == F.col("st_location_id"), "left")
         .join(rs, F.col("rs_id") == F.col("a_record_set_id"), "left")
         .join(ry, F.col("ry_id") == subs.roster_year_id, "left"))
    return d.select(
        subs.id.alias("submissions_id"), F.col("st_location_id").alias("location_id"), "submission_type_id",
        "submission_mode_id", "roster_year_id", F.col("a_record_set_id").alias("record_set_id"),
        F.col("sel_record_id").alias("record_id"), F.col("srf_submission_record_id").alias("submission_record_id"),
        F.col("srf_id").alias("instance_id"), F.col("ou_id").alias("org_unit_id"),
        F.col("l_display_name").alias("location"), F.col("st_name").alias("submission_type"),
        F.col("m_name").alias("submission_mode"), F.col("rs_name").alias("record_set"),
        F.col("ou_name").alias("au"), F.coalesce(F.col("ou_number"), F.lit("Blank")).alias("au_code"),
        roster_year_label("ry_start_year", "-").alias("roster_year"), F.col("a_id").alias("attribute_id"),
        F.col("a_sequence_number").alias("attribute_sequence"), F.col("a_name").alias("attribute"),
        F.col("a_name").alias("col"), F.col("v_value").alias("value"), "started_date", "closed_date",
        F.col("st_form_template_id").alias("template_id"),
        (rec.sequence_number + 1).alias("submission_sequence"))


def form_items(t: dict[str, DataFrame], template_ids=None) -> DataFrame:
    """The form catalogue: every input item on the walked layout (RS1), with its
    type and control. ``with_form_catalogue`` keeps it, and then the layout is
    walked once for all views; it is as large as the forms."""
    chosen = None if template_ids is None else F.col("template_id").isin(list(template_ids))
    if "form_items" in t:
        return t["form_items"] if chosen is None else t["form_items"].filter(chosen)
    roots = F.col("parent_id").isNull()
    tree = flatten_tree(t["form_template_layout"], id="id", parent="parent_id", seq="sequence", roots=roots if chosen is None else roots & chosen,
                        keep=["template_id", "control_id"])
    item = _a(t["form_template_input_item"], "i_", ["id", "input_area_id", "type_id", "sequence", "code", "label", "report_label", "report_weight"])
    it = _a(t["form_template_input_item_type"], "it_", ["id", "name"])
    ft = _a(t["form_template"], "ft_", ["id", "name"])
    ct = _a(t["form_template_control"], "ct_", ["id", "type_id"])
    ctt = _a(t["form_template_control_type"], "ctt_", ["id", "name"])
    d = (tree.join(item, F.col("i_input_area_id") == F.col("control_id"))
         .join(it, F.col("it_id") == F.col("i_type_id"), "left")
         .join(ft, F.col("ft_id") == F.col("template_id"), "left")
         .join(ct, F.col("ct_id") == F.col("control_id"), "left")
         .join(ctt, F.col("ctt_id") == F.col("ct_type_id"), "left"))
    return d.select(
        "template_id", F.col("ft_name").alias("template_name"), F.col("parent_id").alias("layout_parent_id"), "control_id",
        F.col("i_id").alias("attribute_id"), F.col("i_code").alias("attribute_code"), F.col("i_label").alias("attribute_label"),
        F.col("i_report_label").alias("attribute_report_label"), F.coalesce("i_report_label", "i_code").alias("attribute"),
        F.col("i_report_weight").alias("report_weight"), F.col("it_name").alias("input_item_type"),
        F.col("i_sequence").alias("input_item_sequence"), F.col("ctt_name").alias("control_type"),
        F.concat("path", F.coalesce(F.concat(F.lit("_"), (F.lit(100) + F.col("i_sequence")).cast("string")), F.lit("")))
        .alias("display_sequence"))


def with_form_catalogue(t: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """The tables with the form catalogue written once under ``path``."""
    return {**t, "form_items": persist(form_items(t), "form_items", path)}


def persist_views(t: dict[str, DataFrame], path: str, prefix: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """SC3: the tables with the form catalogue, the options and the answer chain kept under
    ``path``: answer values and their side tables bucketed by value, then the
    typed answers and the form instances bucketed by instance (session tables
    named with ``prefix``). Views over the result join answers to their typed
    values and to their instances without an exchange."""
    out = with_form_catalogue(t, path)
    # Kept, the options have a size that the planner knows: a small table is broadcast and the answers stay where they are.
    out["form_template_input_select_field_option"] = persist(t["form_template_input_select_field_option"], "form_template_input_select_field_option", path)
    for name in ("form_input_value", "form_input_text_value", "form_input_single_select_value", "form_input_date_value", "form_input_flag_value"):
        out[name] = persist(t[name], f"{prefix}{name}", path, "id", buckets)
    out["typed_answers"] = persist(typed_answers(out), f"{prefix}typed_answers", path, "instance_id", buckets)
    out["form_instances"] = persist(form_instances(t), f"{prefix}form_instances", path, "instance_id", buckets)
    return out


def _input_items(t: dict[str, DataFrame], template_ids=None) -> DataFrame:
    """The form catalogue with control property and submission item, either of
    which may repeat an item. A property counts unless it is the level or
    sparse (JN4)."""
    prop = _a(t["form_template_control_property"], "cp_", ["control_id", "name", "value"])
    mii = _a(t["mon_submission_item"], "mii_", ["form_template_input_item_id", "label", "sequence"])
    d = form_items(t, template_ids)
    d = join_left_residual(d, prop, F.col("cp_control_id") == F.col("control_id"),
                           (F.col("cp_name") != "Level") & (F.col("cp_value") != "sparse"))
    d = d.join(mii, F.col("mii_form_template_input_item_id") == F.col("attribute_id"), "left")
    return d.select(*[c for c in d.columns if not c.startswith(("cp_", "mii_"))], F.col("cp_name").alias("control_property"),
                    F.col("cp_value").alias("control_property_value"), "mii_label", "mii_sequence")


def typed_answers(t: dict[str, DataFrame]) -> DataFrame:
    """JN5: every answer with its typed values and its form instance."""
    if "typed_answers" in t:
        return t["typed_answers"]
    typed = attach_typed_values(t["form_input_value"], t["form_input_text_value"], t["form_input_single_select_value"],
                                t["form_template_input_select_field_option"], t["form_input_date_value"], t["form_input_flag_value"])
    interval = _a(t["form_instance_interval"], "fii_", ["id", "instance_id"])
    return (typed.join(interval, F.col("interval_id") == F.col("fii_id"))
            .select(F.col("id").alias("value_id"), F.col("fii_instance_id").alias("instance_id"), "input_field_id", "text_value", "selected_option_id",
                    "option_label", "option_report_label", "option_sequence", "date_value", "flag_value"))


def form_instances(t: dict[str, DataFrame]) -> DataFrame:
    """Form instances with the organisation and year of their submission."""
    if "form_instances" in t:
        return t["form_instances"]
    srf = _a(t["mon_submission_record_form"], "srf_", ["id", "submission_record_id"])
    rec = _a(t["mon_submission_record"], "r_", ["id", "submissions_id"])
    sub = _a(t["mon_submissions"], "s_", ["id", "org_unit_id", "roster_year_id"])
    ou = _a(t["org_unit"], "ou_", ["id", "name", "number"])
    ry = _a(t["roster_year"], "ry_", ["id", "start_year"])
    fi = _a(t["form_instance"], "fi_", ["id", "template_id"])
    return (srf.join(rec, F.col("srf_submission_record_id") == F.col("r_id"), "left")
            .join(sub, F.col("r_submissions_id") == F.col("s_id"), "left")
            .join(ou, F.col("ou_id") == F.col("s_org_unit_id"), "left")
            .join(ry, F.col("ry_id") == F.col("s_roster_year_id"), "left")
            .join(fi, F.col("srf_id") == F.col("fi_id"))
            .select(F.col("srf_id").alias("instance_id"), F.col("srf_submission_record_id").alias("submission_record_id"),
                    F.col("fi_template_id").alias("template_id"), "ou_id", "ou_name", "ou_number", "ry_id", "ry_start_year"))


def _forms(t: dict[str, DataFrame], modes: bool) -> DataFrame:
    """Submission types with their location, and their modes if asked for."""
    st = _a(t["mon_submission_type"], "st_", ["id", "name", "location_id", "form_template_id"])
    loc = _a(t["mon_location"], "l_", ["id", "display_name"])
    d = st.join(loc, F.col("l_id") == F.col("st_location_id"), "left")
    out = [F.col("st_form_template_id").alias("form_template_id"), F.col("st_location_id").alias("location_id"), F.col("st_id").alias("submission_type_id"),
           F.col("l_display_name").alias("location"), F.col("st_name").alias("submission_type")]
    if modes:
        m = _a(t["mon_submission_mode"], "m_", ["id", "name", "submission_type_id"])
        d = d.join(m, F.col("m_submission_type_id") == F.col("st_id"), "left")
        out += [F.col("m_id").alias("submission_mode_id"), F.col("m_name").alias("submission_mode")]
    return d.select(*out)


def formlet_columns(t: dict[str, DataFrame], template_ids=None) -> DataFrame:
    """PL1: one row per submission type, mode and form input item: the layout
    walked from the root controls, the items of each input area, their display
    sequence and their number within location, type, mode and template (WN1)."""
    items = _input_items(t, template_ids)
    d = items.join(_forms(t, True), F.col("form_template_id") == items.template_id)
    d = sequence(d, ["location", "submission_type", "submission_mode", "template_name"],
                 ["display_sequence", "attribute_id", "control_property", "mii_label", "control_type"], "attribute_sequence")
    return d.select("template_id", "location_id", "submission_type_id", "submission_mode_id", "location", "submission_type", "submission_mode",
                    "template_name", "display_sequence", "attribute_sequence", "control_type", "input_item_type", "control_property",
                    "attribute_id", "attribute_report_label", "attribute_code", "attribute", "report_weight", "attribute_label")


def formlet_kav(t: dict[str, DataFrame], template_ids=None) -> DataFrame:
    """PL2: typed answers as key/attribute/value rows per form instance, with
    org and year, plus Likert and weighted rows for weighted items (RS7)."""
    items = _input_items(t, template_ids).withColumnRenamed("template_id", "item_template_id")
    items = items.join(_forms(t, False), F.col("form_template_id") == F.col("item_template_id"))
    d = form_instances(t).join(typed_answers(t), "instance_id")
    d = d.join(items, (F.col("item_template_id") == F.col("template_id")) & (F.col("attribute_id") == F.col("input_field_id")))
    # An option shows only on a single-select item, whatever side rows an answer has.
    kav = d.select(
        "location", "submission_type", F.col("ou_id").alias("org_unit_id"), F.col("ry_id").alias("roster_year_id"),
        roster_year_label("ry_start_year", " - ").alias("roster_year"), F.col("ou_name").alias("au"),
        F.col("ou_number").alias("au_code"), "template_id", "template_name", "attribute_id", "mii_label",
        F.col("control_property_value").alias("control_property"),
        "attribute_code", "attribute_report_label", "attribute_label", "input_item_type", "display_sequence",
        "input_item_sequence", "mii_sequence", "instance_id", "submission_record_id",
        decode_value("input_item_type", "report_label").alias("value"),
        decode_value("input_item_type", "label").alias("select_field_label"),
        F.when(F.col("input_item_type") == SINGLE_SELECT, F.col("option_sequence")).alias("value_sequence"),
        "report_weight")
    return emit_scores(kav, value_text=float_text).drop("value_sequence")


def compliance_formlet_attributes(t: dict[str, DataFrame], template_id: str | None) -> DataFrame:
    """PL4: the statements of a checklist (of every form when None) with their section (the submission area
    of the parent control), their number in the template, and the note flag on
    the last statement of each section."""
    items = form_items(t, template_id and [template_id])
    parent = _a(t["form_template_layout"], "p_", ["id", "control_id"])
    area = _a(t["mon_submission_area"], "ar_", ["id", "label", "sequence", "form_template_control_id"])
    d = (items.join(parent, F.col("p_id") == F.col("layout_parent_id"))
         .join(area, F.col("ar_form_template_control_id") == F.col("p_control_id"), "left"))
    d = sequence(d, "template_id", ["display_sequence", "attribute_id"], "sequence")
    d = flag_last(d, ["template_id", "p_control_id"], ["display_sequence", "attribute_id"], "is_note")
    return d.select("template_id", F.col("ar_id").alias("section_id"), F.col("ar_label").alias("section"),
                    F.col("ar_sequence").alias("section_sequence"), "attribute_id", F.col("attribute").alias("short_name"), "sequence",
                    F.col("input_item_type").alias("attribute_type"), "is_note", F.col("attribute_label").alias("statement"),
                    F.col("attribute_code").alias("code"), F.col("attribute_report_label").alias("report_label"))


def checklist_detail(t: dict[str, DataFrame], template_id: str) -> DataFrame:
    """What the checklist reports read: the single-select answers of a form,
    with organisation, year, student and exclusion, the option's label and
    (as ``value``) its report label; an answer without an option is blank."""
    fi = t["form_instance"].filter(F.col("template_id") == F.lit(template_id)).select(F.col("id").alias("instance_id"))
    sel = _a(t["mon_record_selection"], "sel_", ["id", "record_id", "excluded_date"])
    sub = _a(t["mon_submissions"], "s_", ["id", "org_unit_id", "roster_year_id"])
    # What a report leaves out goes before the answers are read: they meet the instances once, and their options after that.
    d = (fi.join(_a(t["mon_submission_record_form"], "rf_", ["id", "submission_record_id"]), F.col("rf_id") == F.col("instance_id"), "left")
         .join(_a(t["mon_submission_record"], "r_", ["id", "submissions_id", "record_selection_id"]), F.col("r_id") == F.col("rf_submission_record_id"), "left")
         .join(sub, F.col("s_id") == F.col("r_submissions_id"), "left")
         .join(_a(t["org_unit"], "ou_", ["id", "name"]), F.col("ou_id") == F.col("s_org_unit_id"), "left")
         .join(sel, F.col("sel_id") == F.col("r_record_selection_id"), "left")
         .join(_a(t["mon_record"], "m_", ["id", "search_key"]), F.col("m_id") == F.col("sel_record_id"), "left")
         .join(_a(t["form_instance_interval"], "fii_", ["id", "instance_id"]), F.col("fii_instance_id") == F.col("instance_id"))
         .join(_a(t["form_input_value"], "v_", ["id", "interval_id", "input_field_id"]), F.col("v_interval_id") == F.col("fii_id"))
         .join(_a(t["form_input_single_select_value"], "ss_", ["id", "selected_option_id"]), F.col("ss_id") == F.col("v_id"))
         .join(_a(t["form_template_input_select_field_option"], "o_", ["id", "label", "report_label"]), F.col("o_id") == F.col("ss_selected_option_id"), "left"))
    return d.select("instance_id", F.col("ou_name").alias("au"), F.col("ou_id").alias("org_unit_id"), F.col("s_roster_year_id").alias("roster_year"),
                    F.col("sel_excluded_date").isNotNull().alias("excluded"), F.col("m_search_key").alias("search_key"),
                    F.col("v_input_field_id").alias("attribute_id"), F.col("o_report_label").alias("value"), F.col("o_label").alias("label"))


def raw_data_by_record_set(t: dict[str, DataFrame], user_id: str, record_set_id: str) -> DataFrame:
    """PL7: one wide row per submission record of the record sets sampled from
    ``record_set_id``, excluded ones too: AU, SASID2, submission sequence,
    exclusion flag, a column for every attribute of the record set and every
    item of its form, answered or not. Weighted items are named by their code;
    names are made unique over both lists. Cells are cleaned for CSV; an item
    type without a rule is refused."""
    sets = t["mon_record_set"].filter(F.col("sampled_from_id") == F.lit(record_set_id)).select(F.col("id").alias("rs_id"))
    every = active(t["mon_submissions"]).join(sets, F.col("rs_id") == F.col("record_set_id")).select(
        F.col("id").alias("s_id"), F.col("record_set_id").alias("s_set_id"), "submission_type_id", "org_unit_id")
    subs = restrict_to_user(every, t["user_profile_org_unit"], user_id)
    rec = _a(t["mon_submission_record"], "sr_", ["id", "submissions_id", "record_selection_id", "sequence_number"])
    sel = _a(t["mon_record_selection"], "sel_", ["id", "record_id", "record_set_id", "excluded_date"])
    ou = _a(t["org_unit"], "ou_", ["id", "name"])
    att = t["mon_record_attribute"].filter(F.col("record_set_id") == F.lit(record_set_id))
    val = t["mon_record_attribute_value"]
    sasid_id = att.filter(F.col("name") == "SASID").agg(F.min("id")).scalar()
    sasid = val.filter(F.col("attribute_id") == sasid_id).select(F.col("record_id").alias("x_record_id"), F.col("value").alias("SASID2"))
    qs = (subs.join(rec, F.col("sr_submissions_id") == F.col("s_id"))
          .join(sel, (F.col("sel_record_set_id") == F.col("s_set_id")) & (F.col("sel_id") == F.col("sr_record_selection_id")), "left")
          .join(sasid, F.col("x_record_id") == F.col("sel_record_id"), "left")
          .join(ou, F.col("ou_id") == F.col("org_unit_id"), "left"))

    # Column lists from metadata, read at once: bounded by the forms, not by the data.
    types = _a(t["mon_submission_type"], "st_", ["id", "form_template_id"])
    templates = every.join(types, F.col("st_id") == F.col("submission_type_id")).select(F.col("st_form_template_id").alias("used"))
    form_name = F.when(F.col("report_weight").isNull(), F.col("attribute")).otherwise(F.col("attribute_code"))
    items = (form_items(t).filter(F.col("layout_parent_id").isNotNull()).join(templates, F.col("template_id") == F.col("used"), "left_semi")
             .select(F.lit(None).cast("int").alias("number"), "display_sequence", F.col("attribute_id").alias("id"), form_name.alias("name")))
    meta = att.select(F.col("sequence_number").alias("number"), F.lit(None).cast("string").alias("display_sequence"), "id", "name").union(items).collect()
    rec_meta = sorted((r for r in meta if r["display_sequence"] is None), key=lambda r: (r["number"] is not None, r["number"] or 0, r["id"]))
    frm_meta = sorted({(r["display_sequence"], r["id"], r["name"]) for r in meta if r["display_sequence"] is not None}, key=lambda r: r[:2])
    fixed = ["AU", "SASID2", "submission_sequence", "is_excluded"]
    names = safe_names(fixed + [r["name"] for r in rec_meta] + [name for _, _, name in frm_meta],
                       fixed + [r["id"] for r in rec_meta] + [i for _, i, _ in frm_meta])[len(fixed):]
    rec_names, frm_names = names[:len(rec_meta)], names[len(rec_meta):]

    values = val.join(_a(t["mon_record"].filter(F.col("record_set_id") == F.lit(record_set_id)), "m_", ["id"]), F.col("m_id") == F.col("record_id"))
    values = values.join(_a(att, "a_", ["id"]), F.col("a_id") == F.col("attribute_id"))
    qr = pivot_attributes(values, ["record_id"], {r["id"]: n for r, n in zip(rec_meta, rec_names, strict=True)})

    fi = t["form_instance"].join(templates, F.col("template_id") == F.col("used"), "left_semi")
    types = (_a(t["form_template_input_item"], "i_", ["id", "type_id"])
             .join(_a(t["form_template_input_item_type"], "it_", ["id", "name"]), F.col("it_id") == F.col("i_type_id"), "left"))
    forms = (_a(t["mon_record"].filter(F.col("record_set_id") == F.lit(record_set_id)), "m_", ["id"])
             .join(sel, F.col("sel_record_id") == F.col("m_id")).join(rec, F.col("sr_record_selection_id") == F.col("sel_id"))
             .join(_a(t["mon_submission_record_form"], "rf_", ["id", "submission_record_id"]), F.col("rf_submission_record_id") == F.col("sr_id"))
             .join(_a(fi, "f_", ["id"]), F.col("f_id") == F.col("rf_id"))
             .join(typed_answers(t), F.col("instance_id") == F.col("f_id"), "left")
             .join(types, F.col("i_id") == F.col("input_field_id"), "left")
             .withColumn("cell", F.when(F.col("input_field_id").isNotNull(), decode_value("it_name", "export"))))
    qf = pivot_attributes(forms, ["m_id"], {i: n for (_, i, _), n in zip(frm_meta, frm_names, strict=True)}, attribute="input_field_id", value="cell")
    out = qs.join(qr, F.col("record_id") == F.col("sel_record_id")).join(qf, F.col("m_id") == F.col("record_id"), "left")
    return out.select(F.col("ou_name").alias("AU"), "SASID2", F.col("sr_sequence_number").alias("submission_sequence"),
                      F.col("sel_excluded_date").isNotNull().cast("int").alias("is_excluded"), *rec_names, *frm_names)
