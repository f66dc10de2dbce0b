"""Registered queries over the native store that follow the source's own shapes: tracked submissions (RP20, RP21), the record
matrix (RP13), column groups found at run time (RP12, RS9), pickers by id (PQ1, PQ6), gates by name (FI12), loading and
exporting (SC1, SC3, SC4), and the order of a report's rows (SO1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reshape as RS
from ..operators.ranking import rank_global, sort_totals_last
from ..sources import native_proxy, proxy
from ..operators.filters import keep_in
from ..operators.joins import decode
from ..functions import contains_ci
from ..sources.tables import ignore_case, load, register_views, write_csv
from . import catalog as C
from . import compliance as CMP
from . import gifted as GIF
from . import native_queries as NQ
from . import outcomes as OUT
from . import pickers as PK
from . import views as V

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def deco(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return deco


def _over_store(body: str, texts: dict[str, str] = native_proxy.STORE) -> str:
    return f"WITH RECURSIVE {native_proxy.ctes(texts=texts)},\n{NQ._ITEMS_SQL},\n{body}"


# -- tracked submissions ------------------------------------------------------------------
_YEAR = "CAST(ry.start_year AS VARCHAR) || '-' || right(CAST(ry.start_year + 1 AS VARCHAR), 2)"
_TRACKED = f"""WITH RECURSIVE {native_proxy.ctes(texts=native_proxy.TRACKED)},
g AS (SELECT l.sequence AS location_sequence, l.display_name AS location, m.submission_type_id, m.id AS submission_mode_id, m.name AS submission_mode, st.form_template_id,
        CAST(row_number() OVER (ORDER BY l.sequence, st.name, CASE m.name WHEN 'Annual Budget Review' THEN 'AU Budget: Review' ELSE m.name END, m.id) AS INTEGER) AS mode_sequence
      FROM mon_location l JOIN mon_submission_type st ON l.id = st.location_id JOIN mon_submission_mode m ON st.id = m.submission_type_id
      WHERE l.program_id = 'PG' AND m.id NOT IN ('MG4')),
aus AS (SELECT DISTINCT s.org_unit_id, ou.name AS au FROM mon_submissions s JOIN org_unit ou ON s.org_unit_id = ou.id JOIN g ON s.submission_type_id = g.submission_type_id
        WHERE ou.id IN (SELECT org_unit_id FROM user_profile_org_unit WHERE user_profile_id = 'U0') AND s.deleted_date IS NULL
          AND s.reliability_check_of_submissions_id IS NULL AND ou.name NOT IN ('TEST', 'TEST AU')),
years AS (SELECT DISTINCT s.roster_year_id, {_YEAR} AS roster_year FROM mon_submissions s JOIN roster_year ry ON s.roster_year_id = ry.id
          JOIN g ON s.submission_type_id = g.submission_type_id WHERE s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL),
walk AS (SELECT id, parent_id, template_id, control_id FROM form_template_layout WHERE parent_id IS NULL
         UNION ALL SELECT c.id, c.parent_id, c.template_id, c.control_id FROM form_template_layout c JOIN walk w ON c.parent_id = w.id),
a AS (SELECT w.template_id, i.id AS attribute_id, i.code, i.label AS input_item_label, it.name AS input_item_type
      FROM walk w JOIN walk p ON w.parent_id = p.id JOIN form_template_input_item i ON i.input_area_id = w.control_id LEFT JOIN form_template_input_item_type it ON i.type_id = it.id),
results AS (
  SELECT au, roster_year, g.location, g.location_sequence, g.submission_mode, g.submission_mode_id, g.mode_sequence, a.attribute_id, a.code, a.input_item_label,
         strftime(s.started_date, '%m/%d/%Y') AS started, strftime(s.closed_date, '%m/%d/%Y') AS closed, o.label
  FROM a LEFT JOIN g ON a.template_id = g.form_template_id CROSS JOIN (SELECT * FROM aus CROSS JOIN years) ay
  LEFT JOIN mon_submissions s ON g.submission_mode_id = s.submission_mode_id AND ay.org_unit_id = s.org_unit_id AND ay.roster_year_id = s.roster_year_id
    AND s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL
  LEFT JOIN mon_submission_record sr ON s.id = sr.submissions_id LEFT JOIN mon_submission_record_form rf ON sr.id = rf.submission_record_id
  LEFT JOIN form_instance fi ON rf.id = fi.id LEFT JOIN form_instance_interval fii ON fi.id = fii.instance_id
  LEFT JOIN form_input_value v ON fii.id = v.interval_id AND a.attribute_id = v.input_field_id LEFT JOIN form_input_single_select_value ss ON v.id = ss.id
  LEFT JOIN form_template_input_select_field_option o ON ss.selected_option_id = o.id
  WHERE a.input_item_label ILIKE '%assistance%' OR (g.submission_mode_id = 'MG3' AND a.input_item_type = 'Date' AND a.code IN ('Rev1', 'Rev2')))"""


def _tracked(spark, sf):
    return native_proxy.store(spark, proxy.read_tables(spark, sf, ("region", "nation", "customer", "orders", "lineitem")), native_proxy.TRACKED)


_HERE = {"program_id": "PG", "user_id": "U0", "excluded": ["MG4"], "review_mode": "MG3"}


@query("tracked_submissions", _TRACKED + """
SELECT au, roster_year, location, submission_mode, submission_mode_id, mode_sequence, 'SubmissionDate' AS attribute, 0 AS attribute_sequence,
       'Date of Submission' AS input_item_label, max(started) AS value FROM results GROUP BY au, roster_year, location, submission_mode, submission_mode_id, mode_sequence
UNION ALL
SELECT au, roster_year, location, CASE code WHEN 'Rev1' THEN '4 Month' WHEN 'Rev2' THEN '8 Month' ELSE submission_mode END, submission_mode_id, mode_sequence, code, 1,
       input_item_label, label FROM results""")
def tracked_submissions(spark, sf):
    """RP20 (JN13, JN14, WN8, FI9, FI10): submission dates and help answers of a program, gaps shown, long form."""
    return GIF.tracked_long(_tracked(spark, sf), **_HERE)


def _wide(label: str, value: str, mode: str, more: str = "") -> str:
    return f"max(CASE WHEN submission_mode_id = '{mode}'{more} THEN coalesce({value}, '') ELSE '' END) AS \"{label}\""


_WIDE = ", ".join(_wide(f"{head}_{part}", value, mode) for mode, head in (("MG3", "Improvement_Improvement_Timeline"), ("MG1", "Profile_Annual_Budget_Review"),
                                                                          ("MG2", "Profile_AU_Budget_Zero"), ("MG5", "Profile_Silent_mode"))
                  for part, value in (("Due_Date", "started"), ("Date_Submitted", "closed"), ("HELP", "label")))
_MONTHS = ", ".join(_wide(f"Improvement_Improvement_Timeline_{name}", "label", "MG3", f" AND input_item_label = '{label}'")
                    for name, label in (("4_Month", "Review Date 1 (4 months after submission):"), ("8_Month", "Review Date 2 (8 months after submission):")))


@query("tracked_submissions_wide", _TRACKED + f"\nSELECT au, roster_year, {_WIDE}, {_MONTHS} FROM results GROUP BY au, roster_year")
def tracked_submissions_wide(spark, sf):
    """RP21 (RS8, RS6): the same as one row per organisation and year, three columns a mode and two review months."""
    return GIF.tracked_wide(_tracked(spark, sf), **_HERE)


# -- record matrix --------------------------------------------------------------------------
_MATRIX = ", ".join(f"arg_min(v.value, v.attribute_id) FILTER (v.attribute_id = 'A{k}') AS \"{n}\"" for k, n in enumerate(("SASID", "District", "School", "Disability", "Year")))


@query("native_record_matrix", _over_store(f"""
r AS (SELECT s.id, sr.record_selection_id, sr.id AS sr_id, sr.sequence_number
      FROM mon_submissions s JOIN mon_submission_record sr ON sr.submissions_id = s.id
      WHERE s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL AND s.submission_mode_id = 'M1' AND s.roster_year_id = 'RY1997'
        AND s.org_unit_id IN (SELECT org_unit_id FROM user_profile_org_unit WHERE user_profile_id = 'U1'))
SELECT CAST(r.sequence_number + 1 AS INTEGER) AS submission_sequence, rf.id AS instance_id, {_MATRIX}
FROM r LEFT JOIN mon_submission_record_form rf ON rf.submission_record_id = r.sr_id LEFT JOIN mon_record_selection sel ON sel.id = r.record_selection_id
JOIN mon_record_attribute_value v ON v.record_id = sel.record_id JOIN mon_record_attribute a ON a.id = v.attribute_id AND a.record_set_id = 'RS0'
WHERE sel.excluded_date IS NULL GROUP BY r.sequence_number, rf.id"""))
def native_record_matrix(spark, sf):
    """RP13 (AG26): record attributes as a matrix, a row per submission sequence and instance."""
    t = NQ._store(spark, sf)
    return OUT.record_matrix_by_instance(V.record_kav(t), t["mon_record_attribute"], "M1", "RS0", "RY1997", t["user_profile_org_unit"], "U1")


# -- column groups found at run time ----------------------------------------------------------
@query("outcomes_column_groups", f"""WITH r AS ({C.ORACLE['rollup_by_dimension']}),
    v AS (SELECT dimension, CAST(row_number() OVER (ORDER BY dimension NULLS FIRST) - 1 AS INTEGER) AS position FROM (SELECT DISTINCT dimension FROM r)),
    k AS (SELECT DISTINCT admin_unit, district, au_sort_bit, district_sort_bit FROM r)
    SELECT k.*, v.position, v.dimension AS value, CAST(sum(r.n_size) AS BIGINT) AS n, CAST(sum(r.met_count) AS BIGINT) AS met
    FROM k CROSS JOIN v LEFT JOIN r ON r.admin_unit = k.admin_unit AND r.district = k.district AND r.au_sort_bit = k.au_sort_bit
      AND r.district_sort_bit = k.district_sort_bit AND r.dimension IS NOT DISTINCT FROM v.dimension GROUP BY ALL""")
def outcomes_column_groups(spark, sf):
    """RP12 (RS9): the outcome rollup with a column group for each dimension value that occurs, as numbered entries."""
    keys = ["admin_unit", "district", "au_sort_bit", "district_sort_bit"]
    wide = RS.crosstab_groups(C.QUERIES["rollup_by_dimension"](spark, sf), keys, "dimension", {"n": F.sum("n_size"), "met": F.sum("met_count")})
    return wide.select(*keys, F.posexplode("groups").alias("position", "g")).select(*keys, "position", "g.*")


# -- pickers by id ------------------------------------------------------------------------------
_PICK = """prm AS (SELECT DISTINCT p.id AS program_id, p.display_name AS program, l.id AS location_id, l.display_name AS location, m.id AS submission_mode_id,
    m.name AS submission_mode, ry.id AS roster_year_id, CAST(ry.start_year AS VARCHAR) || '-' || right(CAST(ry.start_year + 1 AS VARCHAR), 2) AS roster_year,
    ps.id AS record_set_id, ps.name AS record_set
  FROM mon_submissions s LEFT JOIN mon_record_set cs ON cs.id = s.record_set_id AND s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL
  LEFT JOIN mon_record_set ps ON ps.id = cs.sampled_from_id LEFT JOIN mon_submission_type st ON st.id = s.submission_type_id
  LEFT JOIN mon_submission_mode m ON m.id = s.submission_mode_id LEFT JOIN mon_location l ON l.id = st.location_id LEFT JOIN mon_program p ON p.id = l.program_id
  LEFT JOIN roster_year ry ON ry.id = s.roster_year_id
  WHERE ps.id IN (SELECT record_set_id FROM mon_record_attribute WHERE record_set_id IS NOT NULL))
"""


def _picker(choice: str, **chosen):
    where = " AND ".join(["true", *[f"{k} = '{v}'" for k, v in chosen.items()]])

    def fn(spark, sf):
        return PK.raw_data_choices(NQ._store(spark, sf), choice, **chosen)
    fn.__doc__ = f"PQ1: {choice} ids and names left after {', '.join(chosen) or 'no choice'}."
    QUERIES[f"choices_{choice}"] = fn
    ORACLE[f"choices_{choice}"] = _over_store(_PICK + f"SELECT DISTINCT {choice}_id AS id, {choice} AS name FROM prm WHERE {where}")


_picker("program")
_picker("location", program_id="P1")
_picker("submission_mode", program_id="P1", location_id="L1")
_picker("roster_year", program_id="P1", location_id="L1", submission_mode_id="M5")
_picker("record_set", program_id="P1", location_id="L1", submission_mode_id="M5", roster_year_id="RY1997")


@query("choices_outcome_record_set", _over_store("""r AS (SELECT sr.record_selection_id FROM mon_submissions s JOIN mon_submission_record sr ON sr.submissions_id = s.id
    WHERE s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL AND s.submission_mode_id = 'M2')
  SELECT DISTINCT a.record_set_id AS id, rs.name FROM r LEFT JOIN mon_record_selection sel ON sel.id = r.record_selection_id
  LEFT JOIN mon_record_attribute_value v ON v.record_id = sel.record_id LEFT JOIN mon_record_attribute a ON a.id = v.attribute_id
  LEFT JOIN mon_record_set rs ON rs.id = a.record_set_id WHERE sel.excluded_date IS NULL"""))
def choices_outcome_record_set(spark, sf):
    """PQ6: record sets of a mode's submissions."""
    return PK.outcome_record_sets(NQ._store(spark, sf), "M2")


# -- gates by name --------------------------------------------------------------------------------
@query("goal_rows_by_section_name", NQ.ORACLE["native_yes_no_na_blank"])
def goal_rows_by_section_name(spark, sf):
    """RP4 (FI12): the borrowed statement and the overall row, because the chosen section has the name."""
    detail, attrs = NQ._checklist(spark, sf)
    return CMP.compliance_4(detail, attrs, section="ARA", borrow_attribute="I4", when_section="Area A")


_ELSEWHERE = NQ.ORACLE["native_yes_no_na_blank"]
_ELSEWHERE = _ELSEWHERE[:_ELSEWHERE.index("b AS (SELECT au, section")] + f"""r AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END AS au, section_sequence, section, attribute_id,
    CAST(sequence AS DOUBLE) AS position, {NQ._MARKS} FROM d WHERE section_id = 'ARB' GROUP BY ROLLUP(au), section_sequence, section, attribute_id, sequence)
SELECT *, CASE WHEN yes + no > 0 THEN yes / (yes + no) ELSE 0.0 END AS yes_rate FROM r"""


@query("goal_rows_elsewhere", _ELSEWHERE)
def goal_rows_elsewhere(spark, sf):
    """RP4 (FI12): neither of the two, because the chosen section has another name."""
    detail, attrs = NQ._checklist(spark, sf)
    return CMP.compliance_4(detail, attrs, section="ARB", borrow_attribute="I3", when_section="Area A")


# -- loading and exporting ----------------------------------------------------------------------------
_KAV_TABLES = ("org_unit", "roster_year", "mon_location", "mon_submission_type", "mon_submission_mode", "mon_submissions", "mon_submission_record",
               "mon_submission_record_form", "mon_record_set", "mon_record_selection", "mon_record_attribute", "mon_record_attribute_value")


def _written(spark: SparkSession, sf: str, names) -> str:
    """The stand-in store as Parquet, ids in lower case, with a column too many: what a site might deliver."""
    path = NQ._scratch(spark)
    for name in names:
        df = NQ._store(spark, sf)[name]
        ids = [F.lower(c).alias(c) if c == "id" or c.endswith("_id") else F.col(c) for c in df.columns]
        df.select(*ids, F.lit(1).alias("row_version")).write.parquet(f"{path}/{name}")
    return path


@query("loaded_record_kav", NQ.ORACLE["native_record_kav"])
def loaded_record_kav(spark, sf):
    """SC1 + SC3: PL3 as a session view over native tables loaded from Parquet."""
    t = load(spark, _written(spark, sf, _KAV_TABLES), tables=_KAV_TABLES)
    register_views(spark, t, {"record_kav": V.record_kav})
    kav = spark.sql("SELECT * FROM record_kav")
    return kav.withColumns({c: kav[c].cast("timestamp_ntz") for c in ("started_date", "closed_date")})


@query("raw_data_csv", f"SELECT COLUMNS(*)::VARCHAR FROM ({NQ.ORACLE['native_raw_data']})")
def raw_data_csv(spark, sf):
    """SC4 over RP22: the wide export written as CSV and read back as text."""
    wide: DataFrame = V.raw_data_by_record_set(NQ._store(spark, sf), "U1", "RS0")
    path = NQ._scratch(spark)
    write_csv(wide, path)
    return spark.read.option("header", True).option("escape", '"').schema(", ".join(f"`{c}` string" for c in wide.columns)).csv(path)


# -- order of rows ---------------------------------------------------------------------------------
@query("totals_last_ordinal", f"""SELECT *, CAST(row_number() OVER (ORDER BY au_sort_bit, admin_unit NULLS FIRST, district_sort_bit, district NULLS FIRST, dimension NULLS FIRST) AS INTEGER) AS ordinal
    FROM ({C.ORACLE['rollup_by_dimension']})""")
def totals_last_ordinal(spark, sf):
    """SO1: every row of the outcome rollup with its place after the sort that puts totals last. The place is read from the
    sorted rows themselves; the report is as long as its groups."""
    rows = sort_totals_last(C.QUERIES["rollup_by_dimension"](spark, sf), ["au_sort_bit", "district_sort_bit"], ["admin_unit", "district", "dimension"])
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    return rank_global(placed, [F.col("__place")], "ordinal").drop("__place")


# -- checklist and outcome reports over the native views ---------------------------------------------------
def _checklist_report(name: str, base: str, run, *swaps):
    """The report of ``base`` for user U1 and one year; its SQL reads ``d`` and ``st``."""
    body = C.ORACLE[base]
    assert body.startswith(C._CK)
    body = body[len(C._CK):].strip()
    for old, new in swaps:
        body = body.replace(old, new)

    def fn(spark, sf):
        return run(*NQ._checklist(spark, sf, native_proxy.CHECKLIST))
    fn.__doc__ = f"{name}: the report of ``{base}`` over the native views."
    QUERIES[name] = fn
    ORACLE[name] = _over_store(NQ._DETAIL + ("" if body.startswith(",") else "\n") + body, native_proxy.CHECKLIST)


@query("native_checklist_rows", _over_store(NQ._DETAIL + """
SELECT instance_id, section_id, section, section_sequence, attribute_id, sequence, value, is_note FROM d""", native_proxy.CHECKLIST))
def native_checklist_rows(spark, sf):
    """RP1 over the native views."""
    return CMP.compliance_2(*NQ._checklist(spark, sf, native_proxy.CHECKLIST))


_checklist_report("native_note_pairing", "note_pairing", CMP.compliance_2b)
_checklist_report("native_item_pct_of_sample", "item_pct_of_sample", CMP.compliance_4_sample)
_checklist_report("native_section_top_bottom", "section_top_bottom", lambda d, a: CMP.compliance_8_section(d, a, [["ARA", "ARB"], ["ARC"]], n=5),
                  ("('A', 'B')", "('ARA', 'ARB')"), ("('C')", "('ARC')"))

# Fixed values of the stand-in code list; HOUSEHOLD is left out.
_SEGMENTS = [("AUTOMOBILE", "Auto"), ("BUILDING", "Build"), ("FURNITURE", "Furn"), ("MACHINERY", "Mach")]
_RDATA = """SELECT rf.id AS instance_id, ou.name AS au, v.attribute_id, v.value
  FROM mon_submissions s JOIN mon_submission_record sr ON sr.submissions_id = s.id LEFT JOIN mon_submission_record_form rf ON rf.submission_record_id = sr.id
  LEFT JOIN mon_record_selection sel ON sel.id = sr.record_selection_id LEFT JOIN org_unit ou ON ou.id = s.org_unit_id
  LEFT JOIN mon_record_attribute_value v ON v.record_id = sel.record_id LEFT JOIN mon_record_attribute a ON a.id = v.attribute_id
  WHERE s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL AND sel.excluded_date IS NULL AND s.submission_mode_id = 'M2'
    AND ou.id IN (SELECT org_unit_id FROM user_profile_org_unit WHERE user_profile_id = 'U1') AND s.roster_year_id = 'RY1997'
    AND (a.record_set_id IS NULL OR a.record_set_id = 'RS0')"""


def _outcome_sql(dimension: str, levels: int) -> str:
    cols, names = ["au", "district", "school"][:levels], ["admin_unit", "district", "school"]
    totals, bits = ["State Total", "Admin Unit Total", "District Total"], ["au_sort_bit", "district_sort_bit", "school_sort_bit"]
    shown = ", ".join(f"CASE WHEN grouping(r.{c}) = 0 THEN r.{c} ELSE '{t}' END AS {n}, CAST(grouping(r.{c}) AS INTEGER) AS {b}"
                      for c, t, n, b in zip(cols, totals, names, bits, strict=False))
    return _over_store(f"""codes AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{n}')" for c, n in _SEGMENTS)}) AS v(code, name)),
rdata AS ({_RDATA}),
rpivot AS (SELECT instance_id, au, max(CASE WHEN attribute_id = 'A1' THEN value END) AS district, max(CASE WHEN attribute_id = 'A4' THEN value END) AS school,
             max(CASE WHEN attribute_id = 'A2' THEN {dimension} END) AS dimension
           FROM rdata LEFT JOIN codes d ON rdata.value = d.code AND attribute_id = 'A2' GROUP BY instance_id, au),
fpivot AS (SELECT fi.id AS instance_id, max(CASE WHEN coalesce(t.option_report_label, t.option_label) = 'Met' THEN 1 ELSE 0 END) AS answer
           FROM form_instance fi JOIN form_instance_interval fii ON fii.instance_id = fi.id JOIN typed t ON t.interval_id = fii.id
           WHERE t.input_field_id = 'I3' GROUP BY fi.id)
SELECT {shown}, r.dimension, count(DISTINCT r.instance_id) AS n_size, CAST(sum(f.answer) AS BIGINT) AS met_count,
       {C.S.pct_of("sum(f.answer)", "count(DISTINCT r.instance_id)")} AS pct
FROM rpivot r LEFT JOIN fpivot f ON r.instance_id = f.instance_id GROUP BY ROLLUP({', '.join('r.' + c for c in cols)}), r.dimension""")


def _outcomes(spark, sf, code: str, levels: int) -> DataFrame:
    t = NQ._store(spark, sf)
    kav = V.record_kav(t).filter(F.col("roster_year_id") == F.lit("RY1997"))
    answers = V.formlet_kav(t, ["T1"]).select("instance_id", "attribute_id", "value")
    lookup = proxy.code_table(spark, _SEGMENTS, "code string, name string")
    return OUT.pso_report(code, kav, answers, {code: "A2"}, {code: lookup}, question_id="I3", district_attr="A1", school_attr="A4", levels=levels,
                          grants=t["user_profile_org_unit"], user_id="U1", record_set_id="RS0", submission_mode_id="M2")


def _outcome_report(name: str, code: str, dimension: str, levels: int = 3):
    def fn(spark, sf):
        return _outcomes(spark, sf, code, levels)
    fn.__doc__ = f"{name}: outcomes by {OUT.DIMENSIONS[code]} over the native views, of one submission mode."
    QUERIES[name], ORACLE[name] = fn, _outcome_sql(dimension, levels)


_outcome_report("native_outcomes_disability", "D", "d.name")
_outcome_report("native_outcomes_exit_reason", "E", "coalesce(d.name, rdata.value)")
_outcome_report("native_outcomes_gender", "G", "d.name")
_outcome_report("native_outcomes_race", "R", "rdata.value")
_outcome_report("native_outcomes_by_parameter", "E", "coalesce(d.name, rdata.value)", levels=2)


# -- text in any case ------------------------------------------------------------------------------------
@query("mixed_case_groups", C.S.with_base(f"lk AS (SELECT * FROM {C.S.GENDER_SQL})") + """, m AS (SELECT lower(language) AS code, lower(district) AS district FROM inst)
    SELECT m.district, lower(coalesce(lk.name, m.code)) AS status, count(*) AS n FROM m LEFT JOIN lk ON lower(lk.code) = m.code
    WHERE m.code IN ('f', 'o') AND m.district LIKE '%a%' GROUP BY 1, 2""")
def mixed_case_groups(spark, sf):
    """FI1, FI9, JN6 and AG1 on codes and names written in either case: they filter, decode and group alike."""
    odd = F.col("instance_id") % 2 == 1
    inst = proxy.instances(proxy.read_tables(spark, sf, C.ORDER_TABLES))
    inst = inst.select(F.when(odd, F.lower("language")).otherwise(F.col("language")).alias("code"),
                       F.when(odd, F.initcap("district")).otherwise(F.col("district")).alias("district"))
    rows = keep_in(ignore_case(inst), "code", ["f", "O"]).filter(contains_ci("district", "A"))
    named = decode(rows, "code", ignore_case(proxy.gender_codes(spark)), out="status", fallback=True)
    found = named.groupBy("district", "status").agg(F.count(F.lit(1)).alias("n"))
    return found.select(*[F.lower(F.collate(c, "UTF8_BINARY")).alias(c) for c in ("district", "status")], "n")
