"""Registered queries of the native-schema views (PL1-PL4, PL7) and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from ..sources import native_proxy, proxy
from . import compliance as CMP
from . import sqlparts as S
from . import views as V

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, body: str):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = f"WITH RECURSIVE {native_proxy.ctes()},\n{_ITEMS_SQL},\n{body}"
        return fn
    return deco


def _store(spark: SparkSession, sf: str, texts: dict[str, str] = native_proxy.STORE):
    return native_proxy.store(spark, proxy.read_tables(spark, sf, ("region", "nation", "customer", "orders", "lineitem")), texts)


def _scratch(spark: SparkSession) -> str:
    """A new folder below the shared one, for what a query keeps."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/survista/views-{uuid.uuid4().hex}"


_ITEMS_SQL = """walk AS (
  SELECT id, parent_id, template_id, control_id, CAST(100 + sequence AS VARCHAR) AS path FROM form_template_layout WHERE parent_id IS NULL
  UNION ALL
  SELECT c.id, c.parent_id, c.template_id, c.control_id, w.path || '_' || CAST(100 + c.sequence AS VARCHAR)
  FROM form_template_layout c JOIN walk w ON c.parent_id = w.id),
items AS (
  SELECT w.template_id, ft.name AS template_name, w.parent_id AS layout_parent_id, w.control_id, i.id AS attribute_id, i.code, i.label, i.report_label,
         coalesce(i.report_label, i.code) AS attribute, CAST(i.report_weight AS DOUBLE) AS report_weight, it.name AS input_item_type,
         CAST(i.sequence AS INTEGER) AS input_item_sequence, ctt.name AS control_type, cp.name AS control_property, cp.value AS control_property_value,
         mii.label AS mii_label, CAST(mii.sequence AS INTEGER) AS mii_sequence, w.path || '_' || CAST(100 + i.sequence AS VARCHAR) AS display_sequence
  FROM walk w JOIN form_template_input_item i ON i.input_area_id = w.control_id
  LEFT JOIN form_template_input_item_type it ON it.id = i.type_id LEFT JOIN form_template ft ON ft.id = w.template_id
  LEFT JOIN form_template_control ct ON ct.id = w.control_id LEFT JOIN form_template_control_type ctt ON ctt.id = ct.type_id
  LEFT JOIN form_template_control_property cp ON cp.control_id = w.control_id AND cp.name <> 'Level' AND cp.value <> 'sparse'
  LEFT JOIN mon_submission_item mii ON mii.form_template_input_item_id = i.id),
typed AS (
  SELECT v.id, v.interval_id, v.input_field_id, x.value AS text_value, o.label AS option_label, o.report_label AS option_report_label,
         o.sequence AS option_sequence, d.value AS date_value, f.value AS flag_value
  FROM form_input_value v LEFT JOIN form_input_text_value x ON x.id = v.id LEFT JOIN form_input_single_select_value s ON s.id = v.id
  LEFT JOIN form_template_input_select_field_option o ON o.id = s.selected_option_id
  LEFT JOIN form_input_date_value d ON d.id = v.id LEFT JOIN form_input_flag_value f ON f.id = v.id)"""


@query("native_record_kav", """
r AS (SELECT s.*, rec.id AS rec_id, rec.sequence_number, rec.record_selection_id
      FROM mon_submissions s JOIN mon_submission_record rec ON rec.submissions_id = s.id
      WHERE s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL)
SELECT r.id AS submissions_id, st.location_id, r.submission_type_id, r.submission_mode_id, r.roster_year_id, a.record_set_id, sel.record_id,
       rf.submission_record_id, rf.id AS instance_id, ou.id AS org_unit_id, l.display_name AS location, st.name AS submission_type,
       m.name AS submission_mode, rs.name AS record_set, ou.name AS au, coalesce(ou.number, 'Blank') AS au_code,
       CAST(ry.start_year AS VARCHAR) || '-' || right(CAST(ry.start_year + 1 AS VARCHAR), 2) AS roster_year, a.id AS attribute_id,
       CAST(a.sequence_number AS INTEGER) AS attribute_sequence, a.name AS attribute, a.name AS col, v.value, r.started_date, r.closed_date,
       st.form_template_id AS template_id, CAST(r.sequence_number + 1 AS INTEGER) AS submission_sequence
FROM r LEFT JOIN mon_submission_record_form rf ON rf.submission_record_id = r.rec_id
LEFT JOIN mon_record_selection sel ON sel.id = r.record_selection_id LEFT JOIN org_unit ou ON ou.id = r.org_unit_id
LEFT JOIN mon_record_attribute_value v ON v.record_id = sel.record_id LEFT JOIN mon_record_attribute a ON a.id = v.attribute_id
LEFT JOIN mon_submission_mode m ON m.id = r.submission_mode_id LEFT JOIN mon_submission_type st ON st.id = r.submission_type_id
LEFT JOIN mon_location l ON l.id = st.location_id LEFT JOIN mon_record_set rs ON rs.id = a.record_set_id
LEFT JOIN roster_year ry ON ry.id = r.roster_year_id
WHERE sel.excluded_date IS NULL""")
def native_record_kav(spark, sf):
    """PL3: record attributes of live submissions, one row per attribute."""
    kav = V.record_kav(_store(spark, sf))
    return kav.withColumns({c: kav[c].cast("timestamp_ntz") for c in ("started_date", "closed_date")})


@query("native_formlet_columns", """
f AS (SELECT st.form_template_id, st.location_id, st.id AS submission_type_id, m.id AS submission_mode_id, l.display_name AS location,
             st.name AS submission_type, m.name AS submission_mode
      FROM mon_submission_type st LEFT JOIN mon_location l ON l.id = st.location_id LEFT JOIN mon_submission_mode m ON m.submission_type_id = st.id)
SELECT i.template_id, location_id, submission_type_id, submission_mode_id, location, submission_type, submission_mode, template_name,
       display_sequence, CAST(row_number() OVER (PARTITION BY location, submission_type, submission_mode, template_name
         ORDER BY display_sequence NULLS FIRST, attribute_id NULLS FIRST, control_property NULLS FIRST, mii_label NULLS FIRST,
           control_type NULLS FIRST) AS INTEGER) AS attribute_sequence,
       control_type, input_item_type, control_property, attribute_id, report_label AS attribute_report_label, code AS attribute_code, attribute,
       report_weight, label AS attribute_label
FROM items i JOIN f ON f.form_template_id = i.template_id""")
def native_formlet_columns(spark, sf):
    """PL1 (RS1, JN4, WN1): every form's columns by submission type and mode."""
    return V.formlet_columns(_store(spark, sf))


_CELL = """CASE input_item_type WHEN 'SingleSelect' THEN {option} WHEN 'Text' THEN text_value
             WHEN 'Date' THEN strftime(date_value, '%m/%d/%Y') WHEN 'Flag' THEN CASE WHEN flag_value THEN '1' WHEN NOT flag_value THEN '0' END END"""


@query("native_formlet_kav", f"""
frm AS (
  SELECT l.display_name AS location, st.name AS submission_type, ou.id AS org_unit_id, ry.id AS roster_year_id,
         CAST(ry.start_year AS VARCHAR) || ' - ' || right(CAST(ry.start_year + 1 AS VARCHAR), 2) AS roster_year, ou.name AS au, ou.number AS au_code,
         fi.template_id, i.template_name, i.attribute_id, i.mii_label, i.control_property_value AS control_property, i.code AS attribute_code,
         i.report_label AS attribute_report_label, i.label AS attribute_label, i.input_item_type, i.display_sequence, i.input_item_sequence,
         i.mii_sequence, rf.id AS instance_id, rf.submission_record_id, {_CELL.format(option="coalesce(option_report_label, option_label)")} AS value,
         {_CELL.format(option="option_label")} AS select_field_label, i.report_weight, t.option_sequence
  FROM mon_submission_record_form rf LEFT JOIN mon_submission_record r ON r.id = rf.submission_record_id
  LEFT JOIN mon_submissions s ON s.id = r.submissions_id LEFT JOIN org_unit ou ON ou.id = s.org_unit_id
  LEFT JOIN roster_year ry ON ry.id = s.roster_year_id
  JOIN form_instance fi ON fi.id = rf.id JOIN form_instance_interval fii ON fii.instance_id = fi.id JOIN typed t ON t.interval_id = fii.id
  JOIN items i ON i.template_id = fi.template_id AND i.attribute_id = t.input_field_id
  JOIN mon_submission_type st ON st.form_template_id = i.template_id LEFT JOIN mon_location l ON l.id = st.location_id)
SELECT * EXCLUDE (option_sequence), CAST(NULL AS BOOLEAN) AS weighted FROM frm
UNION ALL BY NAME
SELECT * EXCLUDE (option_sequence) REPLACE ('L' || attribute_code AS attribute_code, 'Likert Score ' || attribute_code AS attribute_report_label,
         'Likert Score ' || attribute_code AS attribute_label, 'Derived' AS input_item_type, 'B' || display_sequence AS display_sequence,
         CAST(option_sequence + 1 AS VARCHAR) AS value), false AS weighted FROM frm WHERE report_weight IS NOT NULL
UNION ALL BY NAME
SELECT * EXCLUDE (option_sequence) REPLACE ('W' || attribute_code AS attribute_code, 'Weighted Score ' || attribute_code AS attribute_report_label,
         'Weighted Score ' || attribute_code AS attribute_label, 'Derived' AS input_item_type, 'C' || display_sequence AS display_sequence,
         regexp_replace(CAST((option_sequence + 1) * report_weight AS VARCHAR), '\\.0$', '') AS value), true AS weighted
FROM frm WHERE report_weight IS NOT NULL""")
def native_formlet_kav(spark, sf):
    """PL2 (JN5, PJ3, RS7): typed answers with Likert and weighted rows."""
    return V.formlet_kav(_store(spark, sf))


@query("native_compliance_attributes", """
d AS (SELECT DISTINCT i.* EXCLUDE (control_property, control_property_value, mii_label, mii_sequence), ar.id AS section_id, ar.label AS section,
             CAST(ar.sequence AS INTEGER) AS section_sequence, p.control_id AS parent_control
      FROM items i JOIN form_template_layout p ON p.id = i.layout_parent_id LEFT JOIN mon_submission_area ar ON ar.form_template_control_id = p.control_id)
SELECT template_id, section_id, section, section_sequence, attribute_id, attribute AS short_name,
       CAST(row_number() OVER (PARTITION BY template_id ORDER BY display_sequence, attribute_id) AS INTEGER) AS sequence,
       input_item_type AS attribute_type,
       CAST(CASE WHEN row_number() OVER (PARTITION BY template_id, parent_control ORDER BY display_sequence DESC, attribute_id DESC) = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_note,
       label AS statement, code, report_label
FROM d""")
def native_compliance_attributes(spark, sf):
    """PL4 (JN7, WN1, WN2): every form's statements with section and note flag."""
    return V.compliance_formlet_attributes(_store(spark, sf), None)


_ITEM_CELLS = [(1, "One", "text"), (2, "Q2", "text"), (3, "Q3", "option_label"), (4, "Q4", "option_label"), (5, "SASID_2", "strftime(date_value, '%m/%d/%Y')"),
               (6, "One_2", "CASE WHEN flag_value THEN '1' WHEN NOT flag_value THEN '0' END"), (7, "Q7", "'Multi-select data not pulled'"), (8, "Eight", "text")]
_CLEAN = "text_value"
for _s in ("'<span>'", "'</span>'", "'<p>'", "'</p>'", "'&nbsp'", "';'", "chr(13) || chr(10)", "chr(13)", "chr(10)"):
    _CLEAN = f"replace({_CLEAN}, {_s}, '')"
_REC = ", ".join(f"max(CASE WHEN attribute_id = 'A{i}' THEN value END) AS {n}" for i, n in enumerate(("SASID", "District", "School", "Disability", "Year")))
_FRM = ", ".join(f"max(CASE WHEN input_field_id = 'I{i}' THEN {_CLEAN if c == 'text' else c} END) AS {n}" for i, n, c in _ITEM_CELLS)


@query("native_raw_data", f"""
qs AS (SELECT sel.record_id, sr.sequence_number, sel.excluded_date, x.value AS sasid2, ou.name AS au
       FROM mon_submissions s JOIN mon_submission_record sr ON sr.submissions_id = s.id AND s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL
       JOIN mon_record_set rs ON rs.id = s.record_set_id AND rs.sampled_from_id = 'RS0'
       LEFT JOIN mon_record_selection sel ON sel.record_set_id = s.record_set_id AND sel.id = sr.record_selection_id
       LEFT JOIN mon_record_attribute_value x ON x.record_id = sel.record_id AND x.attribute_id = 'A0' LEFT JOIN org_unit ou ON ou.id = s.org_unit_id
       WHERE s.org_unit_id IN (SELECT org_unit_id FROM user_profile_org_unit WHERE user_profile_id = 'U1')),
qr AS (SELECT record_id, {_REC} FROM mon_record_attribute_value GROUP BY record_id),
qf AS (SELECT m.id AS record_id, {_FRM}
       FROM mon_record m JOIN mon_record_selection sel ON sel.record_id = m.id JOIN mon_submission_record sr ON sr.record_selection_id = sel.id
       JOIN mon_submission_record_form rf ON rf.submission_record_id = sr.id JOIN form_instance fi ON fi.id = rf.id
       LEFT JOIN form_instance_interval fii ON fii.instance_id = fi.id LEFT JOIN typed t ON t.interval_id = fii.id
       WHERE m.record_set_id = 'RS0' GROUP BY m.id)
SELECT qs.au AS AU, qs.sasid2 AS SASID2, CAST(qs.sequence_number AS INTEGER) AS submission_sequence,
       CAST(CASE WHEN qs.excluded_date IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_excluded, qr.* EXCLUDE (record_id), qf.* EXCLUDE (record_id)
FROM qs JOIN qr ON qr.record_id = qs.record_id LEFT JOIN qf ON qf.record_id = qs.record_id""")
def native_raw_data(spark, sf):
    """PL7 / RP22 (RS3): the wide export of a record set for user U1."""
    return V.raw_data_by_record_set(_store(spark, sf), "U1", "RS0")


def _persisted(spark: SparkSession, sf: str):
    path = _scratch(spark)
    return V.persist_views(_store(spark, sf), path, f"v{path[-8:]}_")


def persisted_formlet_kav(spark, sf):
    """SC3 over PL2: typed answers from the kept, bucketed answer chain."""
    return V.formlet_kav(_persisted(spark, sf))


def persisted_raw_data(spark, sf):
    """SC3 over PL7: the wide export from the kept form catalogue and answer chain."""
    return V.raw_data_by_record_set(_persisted(spark, sf), "U1", "RS0")


for _f, _base in ((persisted_formlet_kav, "native_formlet_kav"), (persisted_raw_data, "native_raw_data")):
    QUERIES[_f.__name__], ORACLE[_f.__name__] = _f, ORACLE[_base]


# -- checklist reports over the native views, for user U1 and one roster year ----------
_DETAIL = """att AS (SELECT DISTINCT i.attribute_id, ar.id AS section_id, ar.label AS section, CAST(ar.sequence AS INTEGER) AS section_sequence, i.display_sequence,
               p.control_id AS parent_control
        FROM items i JOIN form_template_layout p ON p.id = i.layout_parent_id LEFT JOIN mon_submission_area ar ON ar.form_template_control_id = p.control_id
        WHERE i.template_id = 'T1'),
ats AS (SELECT * EXCLUDE (parent_control), CAST(row_number() OVER (ORDER BY display_sequence, attribute_id) AS INTEGER) AS sequence,
               CAST(CASE WHEN row_number() OVER (PARTITION BY parent_control ORDER BY display_sequence DESC, attribute_id DESC) = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_note FROM att),
st AS (SELECT * FROM ats),
d AS (SELECT ou.name AS au, fi.id AS instance_id, a.*, o.label, o.report_label AS value
      FROM form_instance fi JOIN form_instance_interval fii ON fii.instance_id = fi.id JOIN form_input_value v ON v.interval_id = fii.id
      JOIN ats a ON a.attribute_id = v.input_field_id JOIN form_input_single_select_value ss ON ss.id = v.id
      LEFT JOIN form_template_input_select_field_option o ON o.id = ss.selected_option_id
      LEFT JOIN mon_submission_record_form rf ON rf.id = fi.id LEFT JOIN mon_submission_record r ON r.id = rf.submission_record_id
      LEFT JOIN mon_record_selection sel ON sel.id = r.record_selection_id LEFT JOIN mon_submissions s ON s.id = r.submissions_id
      LEFT JOIN org_unit ou ON ou.id = s.org_unit_id
      WHERE fi.template_id = 'T1' AND sel.excluded_date IS NULL AND s.roster_year_id = 'RY1997'
        AND ou.id IN (SELECT org_unit_id FROM user_profile_org_unit WHERE user_profile_id = 'U1'))"""


def _checklist(spark: SparkSession, sf: str, texts: dict[str, str] = native_proxy.STORE):
    t = V.with_form_catalogue(_store(spark, sf, texts), _scratch(spark))
    return (CMP.in_scope(V.checklist_detail(t, "T1"), t["user_profile_org_unit"], "U1", "RY1997"),
            V.compliance_formlet_attributes(t, "T1").select("section_id", "section", "section_sequence", "attribute_id", "sequence", "is_note"))


@query("native_section_pct_met", _DETAIL + f"""
SELECT au, section_sequence, section, {S.ratio_half_up("sum(CASE WHEN value = 'Met' THEN 1 END)",
                                                       "sum(CASE WHEN value IN ('Met', 'Not Met') THEN 1 END)", scale=4, precision=19, times=100)} AS pct
FROM d GROUP BY au, section_sequence, section""")
def native_section_pct_met(spark, sf):
    """RP3 over the native views."""
    return CMP.compliance_3(*_checklist(spark, sf))


_MARKS = """CAST(sum(CASE WHEN label = 'Yes' THEN 1 ELSE 0 END) AS DOUBLE) AS yes, CAST(sum(CASE WHEN label = 'No' THEN 1 ELSE 0 END) AS DOUBLE) AS no,
       CAST(sum(CASE WHEN value = 'Not Applicable' THEN 1 ELSE 0 END) AS DOUBLE) AS na, CAST(sum(CASE WHEN label IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS blank,
       CAST(grouping(au) AS INTEGER) AS sort_bit"""


@query("native_yes_no_na_blank", _DETAIL + f""",
b AS (SELECT au, section, section_sequence, attribute_id, CAST(sequence AS DOUBLE) AS position, label, value FROM d WHERE section_id = 'ARA'
      UNION ALL SELECT au, 'Area A', 1, attribute_id, 99.0, label, value FROM d WHERE attribute_id = 'I4'),
r AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END AS au, section_sequence, section, attribute_id, position, {_MARKS}
      FROM b GROUP BY ROLLUP(au), section_sequence, section, attribute_id, position
      UNION ALL SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END, section_sequence, section, NULL, 3.5, {_MARKS}
      FROM b GROUP BY ROLLUP(au), section_sequence, section)
SELECT *, CASE WHEN yes + no > 0 THEN yes / (yes + no) ELSE 0.0 END AS yes_rate FROM r""")
def native_yes_no_na_blank(spark, sf):
    """RP4 over the native views."""
    detail, attrs = _checklist(spark, sf)
    return CMP.compliance_4(detail, attrs, section="ARA", borrow_attribute="I4", borrow_section="ARA")


@query("native_top_bottom", _DETAIL + f""",
c AS (SELECT attribute_id, CAST(sum(CASE WHEN label = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS yes_count,
             CAST(sum(CASE WHEN label IN ('Yes', 'No') THEN 1 ELSE 0 END) AS BIGINT) AS total FROM d GROUP BY attribute_id),
p AS (SELECT *, CAST({S.ratio_half_up('yes_count', 'total', scale=2, times=100)} AS DECIMAL(5,1)) AS pct FROM c WHERE total > 0),
k AS (SELECT *, row_number() OVER (ORDER BY pct DESC, yes_count DESC, attribute_id) AS top_sort,
             row_number() OVER (ORDER BY pct ASC, yes_count ASC, attribute_id) AS bottom_rank FROM p)
SELECT 'Top' AS position, CAST(top_sort AS INTEGER) AS sort, CAST(bottom_rank AS INTEGER) AS bottom_rank, attribute_id, pct FROM k WHERE top_sort <= 5
UNION ALL SELECT 'Bottom', CAST(top_sort AS INTEGER), CAST(bottom_rank AS INTEGER), attribute_id, pct FROM k WHERE bottom_rank <= 5""")
def native_top_bottom(spark, sf):
    """RP6 over the native views."""
    return CMP.compliance_8(_checklist(spark, sf)[0], n=5)
