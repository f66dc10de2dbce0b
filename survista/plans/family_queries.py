"""Registered queries of the family survey over the native store (PL5, PL6, RP14-RP19, PQ7) and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import restrict_to_user, years_in_window
from ..sources import native_proxy, proxy
from . import catalog as C
from . import family as FAM
from . import family_store as FS
from . import pickers as PK

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
USER = "U1"
# Fixed values of the stand-in survey (see ``native_proxy.FAMILY``).
SURVEY = {"submission_type_id": "ST1", "attributes": {"district": "A1", "school": "A2", "disability": "A3", "grade": "A5"}, "outside": ["M5"]}
FORM = {"template_id": "TF", "dropped": ["IDROP1", "IDROP2"], "ignored": "INOTE"}
QUESTIONS, HIGH = C.QUESTIONS, C.LIKERT75_MIN

_CODES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FS.DISABILITIES.items())
_BASE = f"""WITH {native_proxy.ctes(texts=native_proxy.FAMILY)},
sub AS (
  SELECT ou.id AS org_unit_id, rf.id AS instance_id, ry.id AS roster_year_id, CAST(ry.start_year AS VARCHAR) || '-' || right(CAST(ry.start_year + 1 AS VARCHAR), 2) AS roster_year,
         ou.name AS au, coalesce(vd.value, 'Blank') AS district, coalesce(vs.value, 'Blank') AS school, coalesce(vx.value, 'Blank') AS disability,
         CASE coalesce(vx.value, 'Blank') {_CODES} ELSE coalesce(vx.value, 'Blank') END AS disab, coalesce(vg.value, 'Blank') AS grade, rec.search_key
  FROM mon_submission_record_form rf LEFT JOIN mon_submission_record sr ON rf.submission_record_id = sr.id
  LEFT JOIN mon_record_selection sel ON sr.record_selection_id = sel.id
  LEFT JOIN mon_record_attribute_value vd ON sel.record_id = vd.record_id AND vd.attribute_id = 'A1'
  LEFT JOIN mon_record_attribute_value vs ON sel.record_id = vs.record_id AND vs.attribute_id = 'A2'
  LEFT JOIN mon_record_attribute_value vx ON sel.record_id = vx.record_id AND vx.attribute_id = 'A3'
  LEFT JOIN mon_record_attribute_value vg ON sel.record_id = vg.record_id AND vg.attribute_id = 'A5'
  LEFT JOIN mon_record rec ON sel.record_id = rec.id LEFT JOIN mon_submissions s ON sr.submissions_id = s.id
  LEFT JOIN org_unit ou ON s.org_unit_id = ou.id LEFT JOIN roster_year ry ON s.roster_year_id = ry.id
  WHERE sel.excluded_date IS NULL AND s.submission_type_id = 'ST1' AND s.submission_mode_id <> 'M5' AND s.reliability_check_of_submissions_id IS NULL
    AND s.deleted_date IS NULL),
v AS (
  SELECT fiv.input_field_id, fii.instance_id, l.sequence AS layout_sequence, i.sequence + 1 AS item_sequence, i.code, i.label, o.label AS response,
         CASE WHEN i.report_weight IS NULL THEN NULL ELSE o.sequence + 1 END AS likert_score, CAST(i.report_weight AS DOUBLE) AS report_weight
  FROM form_instance_interval fii LEFT JOIN form_input_value fiv ON fii.id = fiv.interval_id LEFT JOIN form_template_input_item i ON fiv.input_field_id = i.id
  LEFT JOIN form_template_layout l ON i.input_area_id = l.control_id LEFT JOIN form_input_single_select_value ss ON fiv.id = ss.id
  LEFT JOIN form_template_input_select_field_option o ON ss.selected_option_id = o.id AND o.deleted_date IS NULL
  WHERE l.template_id = 'TF' AND i.id NOT IN ('IDROP1', 'IDROP2')),
resp AS (
  SELECT v.instance_id, v.layout_sequence, v.input_field_id AS attribute_id, v.item_sequence, v.code, v.label, coalesce(v.response, 'Blank') AS response,
         v.likert_score, v.report_weight
  FROM v LEFT JOIN (SELECT instance_id FROM v WHERE input_field_id <> 'INOTE' GROUP BY instance_id HAVING count(response) = 0) n ON v.instance_id = n.instance_id
  WHERE n.instance_id IS NULL),
p AS (
  SELECT sub.* EXCLUDE (grade), CASE WHEN grade IN ('006', '007') THEN '006,007' ELSE grade END AS grade, coalesce(lang.response, 'Blank') AS language,
         coalesce(m.response, 'Blank') AS disability_match, i.id AS attribute_id, i.sequence + 1 AS question, i.code AS question_code, i.label AS question_text,
         i.report_label AS question_report_label, q.response, q.likert_score, CAST(i.report_weight AS DOUBLE) AS response_weight,
         q.likert_score * q.report_weight AS weighted_score, CASE WHEN q.likert_score > 3 THEN 'Likert 4 or 5' ELSE '' END AS likert_gt3
  FROM sub LEFT JOIN resp q ON sub.instance_id = q.instance_id AND q.layout_sequence = 4 LEFT JOIN form_template_input_item i ON q.attribute_id = i.id
  LEFT JOIN resp lang ON sub.instance_id = lang.instance_id AND lang.layout_sequence = 0
  LEFT JOIN resp m ON sub.instance_id = m.instance_id AND m.layout_sequence = 2),
fm AS (
  SELECT p.*, CAST(CASE WHEN k.n >= {HIGH} THEN 1 ELSE 0 END AS INTEGER) AS likert75
  FROM p LEFT JOIN (SELECT instance_id, sum(CASE WHEN likert_score > 3 THEN 1 ELSE 0 END) AS n FROM p GROUP BY instance_id) k ON p.instance_id = k.instance_id),
fmu AS (SELECT * FROM fm WHERE org_unit_id IN (SELECT org_unit_id FROM user_profile_org_unit WHERE user_profile_id = '{USER}'))"""


def query(name: str, sql: str):
    def deco(fn):
        QUERIES[name], ORACLE[name] = fn, _BASE + sql
        return fn
    return deco


def _store(spark, sf):
    return native_proxy.store(spark, proxy.read_tables(spark, sf, ("region", "nation", "customer", "orders", "lineitem")), native_proxy.FAMILY)


def _master(spark, sf, user: str | None = None, year: str = "", as_of: str = ""):
    """The master of all live submissions, or of those that a report of the ``user`` and ``year`` (or window of years) reads."""
    t = _store(spark, sf)
    subs = t["mon_submissions"] if user is None else restrict_to_user(t["mon_submissions"], t["user_profile_org_unit"], user)
    if as_of:
        window = years_in_window(t["roster_year"], as_of).select(F.col("id").alias("__year"))
        subs = subs.join(window, F.col("roster_year_id") == F.col("__year"), "left_semi")
    read = {**t, "mon_submissions": subs.filter(F.col("roster_year_id") == F.lit(year)) if year else subs}
    return t, FS.master(read, **SURVEY, **FORM, likert75_min=HIGH, one_row=user is not None)


@query("family_submissions_native", " SELECT * FROM sub")
def family_submissions_native(spark, sf):
    """PL5: form instances of the survey with record attributes read from EAV."""
    return FS.submissions(_store(spark, sf), **SURVEY)


@query("family_responses_native", """ SELECT * REPLACE (CAST(layout_sequence AS INTEGER) AS layout_sequence, CAST(item_sequence AS INTEGER) AS item_sequence,
    CAST(likert_score AS INTEGER) AS likert_score) FROM resp""")
def family_responses_native(spark, sf):
    """PL5 (JN12, AG15): answers of forms that are not all blank."""
    return FS.responses(_store(spark, sf), **FORM)


@query("family_master_native", """ SELECT * REPLACE (CAST(question AS INTEGER) AS question, CAST(likert_score AS INTEGER) AS likert_score) FROM fm""")
def family_master_native(spark, sf):
    """PL6 (AG20 in one read): one row per instance and question."""
    return _master(spark, sf)[1]


def _report(name: str, base: str, run, more: str = "", year: str = "", as_of: str = ""):
    """The report of ``base`` over the native master; its SQL reads ``fmu``. ``as_of``: the report's own window of years, so that the
    master reads no others."""
    body = C.ORACLE[base]
    assert body.startswith(C._FM)

    def fn(spark, sf):
        t, m = _master(spark, sf, USER, year, as_of)
        if year:
            m = m.filter(F.col("roster_year_id") == F.lit(year))
        return run(m, {"grants": t["user_profile_org_unit"], "user_id": USER}, t)
    fn.__doc__ = f"{name}: the report of ``{base}`` over the native family master."
    QUERIES[name] = fn
    head = _BASE if not year else _BASE.removesuffix(")") + f" AND roster_year_id = '{year}')"
    ORACLE[name] = head + more + body[len(C._FM):].lstrip()


_report("family_2_native", "mean_of_means_pivot", lambda m, who, t: FAM.family_2(m, QUESTIONS, **who))
_report("family_3_native", "pct_ge4_excl_blank", lambda m, who, t: FAM.family_3(m, QUESTIONS, **who))
_report("family_6_native", "rollup_regroup_weights", lambda m, who, t: FAM.family_6(m, question_text=F.col("question_text"), **who), year="RY1997")
ORACLE["family_6_native"] = ORACLE["family_6_native"].replace("' - Question' || CAST(question AS VARCHAR)", "' - ' || question_text")
_report("family_7_native", "pct_ge4_incl_blank", lambda m, who, t: FAM.family_7(m, level="District", **who), year="RY1997")
_report("family_8_native", "top_bottom_join", lambda m, who, t: FAM.family_8(m.withColumn("question", F.col("question_text")), n=3, **who))
_report("family_9_native", "top_bottom_yearly", lambda m, who, t: FAM.family_9(
    m.withColumn("question", F.col("question_text")), t["roster_year"], C.AS_OF, n=3, year="roster_year_id", year_key="id", **who), as_of=C.AS_OF)
for _n in ("family_8_native", "family_9_native"):  # these two show the question's text
    ORACLE[_n] = ORACLE[_n].replace("fmu AS (SELECT * FROM fm", "fmu AS (SELECT * REPLACE (question_text AS question) FROM fm")
ORACLE["family_9_native"] = ORACLE["family_9_native"].replace(
    "roster_year IN (SELECT start_year FROM win)", "roster_year_id IN (SELECT id FROM roster_year WHERE start_year IN (SELECT start_year FROM win))").replace(
    """SELECT DISTINCT roster_year AS start_year, make_date(roster_year, 7, 1) AS start_date,
                   make_date(roster_year + 1, 6, 30) AS end_date FROM inst""", "SELECT start_year, start_date, end_date FROM roster_year")


@query("picker_family_years", """, y AS (SELECT DISTINCT roster_year_id AS id, roster_year AS name FROM fm)
    SELECT id, name FROM y ORDER BY name, id LIMIT 3""")
def picker_family_years(spark, sf):
    """PQ7 (SO4): the first three roster years of the family master."""
    return PK.family_years(_master(spark, sf)[1])


@query("picker_family_default_year", """ SELECT DISTINCT roster_year_id AS id, roster_year AS name FROM fm ORDER BY name, id LIMIT 1""")
def picker_family_default_year(spark, sf):
    """PQ7 (SO3): the earliest roster year of the family master."""
    return PK.family_years(_master(spark, sf)[1], n=1)


@query("picker_family_choices", """, c AS (SELECT * FROM (VALUES ('language', 'All'), ('language', 'English'), ('language', 'Spanish'), ('language', 'Blank'),
      ('match', 'All'), ('match', 'Yes'), ('match', 'No'), ('match', 'Blank')) AS t(parameter, id))
    SELECT parameter, c.id, c.id AS name, count(DISTINCT fm.instance_id) AS instances
    FROM c LEFT JOIN fm ON c.id = 'All' OR c.id = CASE parameter WHEN 'language' THEN left(fm.language, 10) ELSE left(fm.disability_match, 10) END GROUP BY 1, 2, 3""")
def picker_family_choices(spark, sf):
    """PQ7 (SC2): the fixed language and match lists, and how many instances each choice leaves."""
    return PK.family_choices(spark, _master(spark, sf)[1])
