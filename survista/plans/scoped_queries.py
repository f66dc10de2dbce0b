"""Registered queries of reports for one user and year, of the pickers, and of operators that other queries do not reach."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import filters as FI
from ..operators import measures as ME
from ..operators import ranking as RK
from ..operators import reshape as RS
from ..operators.joins import keep_answered
from ..sources import native_proxy, proxy
from . import catalog as C
from . import compliance as CMP
from . import family as FAM
from . import gifted as GIF
from . import native_queries as NQ
from . import pickers as PK
from . import sqlparts as S
from .outcomes import DIMENSIONS, pso_report, record_matrix

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
USER, YEAR = "U1", 1997


def query(name: str, sql: str):
    def deco(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return deco


# -- checklist reports for one user and year ---------------------------------------
_SCOPED = C._CK.replace("FROM ans a JOIN inst i ON a.instance_id = i.instance_id)", f"""FROM ans a JOIN inst i ON a.instance_id = i.instance_id
      WHERE i.org_unit_id IN (SELECT org_unit_id FROM {S.GRANTS_SQL} WHERE user_profile_id = '{USER}') AND i.roster_year = {YEAR} AND i.language <> 'P')""", 1)
assert _SCOPED != C._CK


def _scope(spark, sf):
    t = proxy.read_tables(spark, sf, C.ORDER_TABLES)
    detail = CMP.in_scope(proxy.checklist_detail(t), proxy.grants(spark), USER, YEAR)
    return t, detail, CMP.compliance_attributes(proxy.statements(spark))


def _report(name: str, base: str, run):
    body = C.ORACLE[base]
    assert body.startswith(C._CK)

    def fn(spark: SparkSession, sf: str):
        _, detail, attrs = _scope(spark, sf)
        return run(detail, attrs)
    fn.__doc__ = f"{name}: the report of ``{base}`` for user {USER} and roster year {YEAR}, excluded records left out."
    QUERIES[name], ORACLE[name] = fn, _SCOPED + body[len(C._CK):]


_report("note_pairing_user", "note_pairing", CMP.compliance_2b)
_report("section_pct_met_user", "section_pct_met", CMP.compliance_3)
_report("yes_no_na_blank_user", "yes_no_na_blank", lambda d, a: CMP.compliance_4(d, a, section="A", borrow_attribute=7, borrow_section="A"))
_report("item_pct_of_sample_user", "item_pct_of_sample", CMP.compliance_4_sample)
_report("top_bottom_global_user", "top_bottom_global", lambda d, a: CMP.compliance_8(d, n=5))
_report("section_top_bottom_user", "section_top_bottom", lambda d, a: CMP.compliance_8_section(d, a, [["A", "B"], ["C"]], n=5))


@query("checklist_rows_user", _SCOPED + "SELECT instance_id, section_id, section, section_sequence, attribute_id, sequence, value, is_note FROM d")
def checklist_rows_user(spark, sf):
    """RP1: checklist rows of the user's organisations in a year."""
    _, detail, attrs = _scope(spark, sf)
    return CMP.compliance_2(detail, attrs)


@query("checklist_rows_student", C._CK + "SELECT instance_id, section_id, section, section_sequence, attribute_id, sequence, value, is_note FROM d WHERE coalesce(search_key, 'xyz123abc') = '7'")
def checklist_rows_student(spark, sf):
    """RP1 (FI8): checklist rows of one student, looked up over all of them."""
    t = proxy.read_tables(spark, sf, C.ORDER_TABLES)
    return CMP.compliance_2(proxy.checklist_detail(t), CMP.compliance_attributes(proxy.statements(spark)), search_key="7")


_PCT = S.ratio_half_up("sum(CASE WHEN value = 'Met' THEN 1 END)", "sum(CASE WHEN value IN ('Met', 'Not Met') THEN 1 END)", scale=4, precision=19, times=100)


@query("section_pct_met_by_mode", _SCOPED + f"SELECT au, i.mode, section_sequence, section, {_PCT} AS pct FROM (SELECT d.*, substr(inst.priority, 1, 1) AS mode FROM d JOIN inst ON d.instance_id = inst.instance_id) i GROUP BY au, i.mode, section_sequence, section")
def section_pct_met_by_mode(spark, sf):
    """RP3: percent Met per AU, type of review and section."""
    t, detail, attrs = _scope(spark, sf)
    mode = proxy.instances(t).select("instance_id", F.substring("priority", 1, 1).alias("mode"))
    return CMP.compliance_3(detail.join(mode, "instance_id"), attrs, by=["au", "mode"])


@query("section_statement_counts", C._CK + """SELECT s.section_id, s.section, s.section_sequence, count(*) AS total, any_value(n.answers) AS answers
    FROM st s LEFT JOIN (SELECT section_id, count(*) AS answers FROM d GROUP BY 1) n ON s.section_id = n.section_id GROUP BY 1, 2, 3""")
def section_statement_counts(spark, sf):
    """AG22: statements of each section, beside the answers given to them."""
    t = proxy.read_tables(spark, sf, C.ORDER_TABLES)
    attrs = CMP.compliance_attributes(proxy.statements(spark))
    answers = proxy.checklist_detail(t).join(attrs, "attribute_id").groupBy("section_id").agg(F.count(F.lit(1)).alias("answers"))
    return CMP.section_totals(attrs).join(answers, "section_id", "left").select("section_id", "section", "section_sequence", "total", "answers")


@query("instance_yes_counts", _SCOPED + """SELECT d.au, d.instance_id, CAST(sum(CASE WHEN label = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS yes_count, max(t.total) AS section_count
    FROM d LEFT JOIN (SELECT section_id, count(*) AS total FROM st GROUP BY 1) t ON t.section_id = d.section_id GROUP BY 1, 2""")
def instance_yes_counts(spark, sf):
    """AG23: yes answers of each instance and the statements of its largest section."""
    _, detail, attrs = _scope(spark, sf)
    return CMP.instance_counts(detail, attrs)


# -- outcome reports ------------------------------------------------------------------
def _pso(name: str, code: str, attribute: str, lookup: str, table, fallback: bool, raw: bool = False):
    sql = C._pso_sql(attribute, lookup, fallback, 3, USER)
    if raw:
        sql = sql.replace("d.name", "r.value")

    def fn(spark, sf):
        t = proxy.read_tables(spark, sf, C.ORDER_TABLES)
        return pso_report(code, proxy.record_kav(t), proxy.answers(t), question_id=1, attributes={code: attribute},
                          lookups={code: table(spark)}, district_attr="DISTRICT", school_attr="SCHOOL", grants=proxy.grants(spark), user_id=USER)
    fn.__doc__ = f"{name}: outcomes by {DIMENSIONS[code]} for user {USER}."
    QUERIES[name], ORACLE[name] = fn, sql


_pso("outcomes_by_exit_reason", "E", "DISABILITY", S.DISAB_SQL, proxy.disability_codes, True)
_pso("outcomes_by_gender", "G", "GENDER", S.GENDER_SQL, proxy.gender_codes, False)
_pso("outcomes_by_race", "R", "YEAR", S.GENDER_SQL, proxy.gender_codes, False, raw=True)


@query("outcomes_crosstab", f"""WITH r AS ({C.ORACLE['rollup_by_dimension']})
    SELECT admin_unit, district, au_sort_bit, district_sort_bit,
           CAST(sum(CASE WHEN dimension = 'Female' THEN n_size END) AS BIGINT) AS "Female_n", CAST(sum(CASE WHEN dimension = 'Female' THEN met_count END) AS BIGINT) AS "Female_met",
           CAST(sum(CASE WHEN dimension = 'Other' THEN n_size END) AS BIGINT) AS "Other_n", CAST(sum(CASE WHEN dimension = 'Other' THEN met_count END) AS BIGINT) AS "Other_met"
    FROM r GROUP BY 1, 2, 3, 4""")
def outcomes_crosstab(spark, sf):
    """RP12 (RS9, AG27): the outcome rollup with a column group for each dimension value."""
    rows = C.QUERIES["rollup_by_dimension"](spark, sf)
    return RS.crosstab(rows, ["admin_unit", "district", "au_sort_bit", "district_sort_bit"], "dimension", ["Female", "Other"],
                       {"n": F.sum("n_size"), "met": F.sum("met_count")})


@query("record_matrix_user", S.with_base(f"grants AS (SELECT * FROM {S.GRANTS_SQL})") + f"""SELECT au, attribute_id, arg_min(value, instance_id) AS first_value, count(*) AS n_records
    FROM rk WHERE org_unit_id IN (SELECT org_unit_id FROM grants WHERE user_profile_id = '{USER}') AND roster_year = {YEAR} GROUP BY au, attribute_id""")
def record_matrix_user(spark, sf):
    """RP13: the record matrix for one user and year."""
    t = proxy.read_tables(spark, sf, C.ORDER_TABLES)
    return record_matrix(proxy.record_kav(t), grants=proxy.grants(spark), user_id=USER, roster_year=YEAR)


# -- family reports ---------------------------------------------------------------------
for _level, _cols in (("AU", ["au"]), ("School", ["au", "district", "school"])):
    def _family_7(spark, sf, level=_level):
        _, m = C._master(spark, sf)
        return FAM.family_7(m, level=level, grants=proxy.grants(spark), user_id=USER)
    _family_7.__doc__ = f"RP17 (FI14): question means at {_level} level."
    QUERIES[f"question_means_{_level.lower()}"] = _family_7
    ORACLE[f"question_means_{_level.lower()}"] = C._FM.replace("user_profile_id = 'U0'", f"user_profile_id = '{USER}'") + f"""
    SELECT {', '.join(_cols)}, question, avg(CAST(likert_score AS DOUBLE)) AS mean_likert,
           avg(CAST(CASE WHEN likert_score > 3 THEN 1 ELSE 0 END AS DOUBLE)) AS pct_gt3 FROM fmu GROUP BY {', '.join(_cols)}, question"""


@query("mean_pivot_au_only", f"SELECT * FROM ({C.ORACLE['mean_of_means_pivot']}) WHERE district_bit = 1 AND school_bit = 1")
def mean_pivot_au_only(spark, sf):
    """RP14 (FI13): only the AU and State rows of the rollup."""
    _, m = C._master(spark, sf)
    return FAM.family_2(m, C.QUESTIONS, grants=proxy.grants(spark), user_id="U0", au_only=True)


@query("answered_instances", C._FM + "SELECT instance_id, count(*) AS n FROM fm GROUP BY 1 HAVING count(likert_score) > 0")
def answered_instances(spark, sf):
    """AG29: instances with a scored answer, and their rows."""
    _, m = C._master(spark, sf)
    return keep_answered(m, "instance_id", "likert_score").groupBy("instance_id").agg(F.count(F.lit(1)).alias("n"))


# -- gifted -------------------------------------------------------------------------------
_RENAME = {"4": "0"}  # fixed value: mode 4 sorts under another name
_CODES = [("H1", "Assistance with budget", "Flag"), ("H2", "Other question", "Text"), ("REV1", "Review", "Date")]
_MODES = ["1", "2", "3", "5"]
_GIF = S.with_base("""sub AS (SELECT org_unit_id, roster_year, substr(priority, 1, 1) AS mode, order_date FROM inst WHERE language = 'F')""",
                   f"""au AS (SELECT DISTINCT org_unit_id, au FROM inst WHERE org_unit_id IN (SELECT org_unit_id FROM {S.GRANTS_SQL} WHERE user_profile_id = '{USER}'))""",
                   """md AS (SELECT mode, CAST(row_number() OVER (ORDER BY mode) AS INTEGER) AS mode_sequence
                             FROM (SELECT DISTINCT substr(priority, 1, 1) AS mode FROM inst) WHERE mode <> '4')""",
                   """sk AS (SELECT au.*, y.roster_year, md.* FROM au, (SELECT DISTINCT roster_year FROM inst) y, md)""",
                   """att AS (SELECT mode, 'H1' AS code, 'Assistance with budget' AS label FROM md UNION ALL SELECT '2', 'REV1', 'Review')""",
                   """an AS (SELECT i.org_unit_id, i.roster_year, substr(i.priority, 1, 1) AS mode, CASE a.attribute_id WHEN 1 THEN 'H1' WHEN 2 THEN 'H2' ELSE 'REV1' END AS code,
                                    a.value FROM ans a JOIN inst i ON a.instance_id = i.instance_id WHERE a.attribute_id <= 3 AND i.language = 'F')""",
                   """lg AS (SELECT sk.au, sk.roster_year, sk.mode, sk.mode_sequence, 'SubmissionDate' AS attribute, 0 AS attribute_sequence, 'Date of Submission' AS input_item_label,
                                    max(strftime(sub.order_date, '%m/%d/%Y')) AS value
                             FROM sk LEFT JOIN sub ON sub.org_unit_id = sk.org_unit_id AND sub.roster_year = sk.roster_year AND sub.mode = sk.mode GROUP BY ALL
                             UNION ALL
                             SELECT sk.au, sk.roster_year, sk.mode, sk.mode_sequence, att.code, 1, att.label, an.value
                             FROM sk JOIN att ON att.mode = sk.mode LEFT JOIN an ON an.org_unit_id = sk.org_unit_id AND an.roster_year = sk.roster_year
                               AND an.mode = sk.mode AND an.code = att.code)""")


def _gifted_long(spark, sf):
    t = proxy.read_tables(spark, sf, C.ORDER_TABLES)
    inst = proxy.instances(t).withColumn("mode", F.substring("priority", 1, 1))
    modes = GIF.mode_sequence(inst.select("mode"), rename=_RENAME, exclude=["4"])
    codes = proxy.code_table(spark, _CODES, "code string, label string, item_type string")
    asked = GIF.help_attributes(inst.select("mode").distinct().withColumn("c", F.explode(F.array(*[F.lit(c) for c, _, _ in _CODES])))
                                .join(codes, F.col("c") == F.col("code")), review_mode="2", review_codes=["REV1", "REV2"])
    asked = asked.join(modes.select("mode"), "mode", "left_semi")
    done = inst.filter(F.col("language") == "F")
    code = F.when(F.col("attribute_id") == 1, "H1").when(F.col("attribute_id") == 2, "H2").otherwise("REV1")
    answers = proxy.answers(t).filter("attribute_id <= 3").join(done, "instance_id").select("org_unit_id", "roster_year", "mode", code.alias("code"), "value")
    subs = done.select("org_unit_id", "roster_year", "mode", F.col("order_date").alias("started_date"))
    return GIF.gifted_long(subs, inst, inst.select("roster_year"), modes, asked, answers, grants=proxy.grants(spark), user_id=USER)


@query("densify_gaps", _GIF + "SELECT * FROM lg")
def densify_gaps(spark, sf):
    """RP20 (JN13, JN14, WN8, FI2, FI9, FI10): submission dates and help answers, gaps shown, long form."""
    return _gifted_long(spark, sf)


_WIDE = ", ".join(f"coalesce(max(CASE WHEN mode = '{m}' AND attribute = '{a}' THEN value END), '') AS m{m}_{n}"
                  for m in _MODES for a, n in (("SubmissionDate", "submitted"), ("H1", "h1"), ("REV1", "rev1")))


@query("wide_crosstab_blank_default", _GIF + f"SELECT au, roster_year, {_WIDE} FROM lg GROUP BY au, roster_year")
def wide_crosstab_blank_default(spark, sf):
    """RP21 (RS6): the same as one wide row per org x year, '' for gaps."""
    return GIF.gifted_wide(_gifted_long(spark, sf), _MODES, ["H1", "REV1"], names=[f"m{m}" for m in _MODES])


# -- pickers over the native store ------------------------------------------------------
def _native(name: str, sql: str, run):
    def fn(spark, sf):
        return run(NQ._store(spark, sf))
    fn.__doc__ = f"{name}: picker or list over the native store."
    QUERIES[name] = fn
    ORACLE[name] = f"WITH RECURSIVE {native_proxy.ctes()},\n{NQ._ITEMS_SQL},\n{sql}"


_PARAMS = """prm AS (SELECT DISTINCT p.display_name AS program, l.display_name AS location, st.name AS submission_type, m.name AS submission_mode,
    CAST(ry.start_year AS VARCHAR) || '-' || right(CAST(ry.start_year + 1 AS VARCHAR), 2) AS roster_year, ps.id AS record_set_id, ps.name AS record_set
  FROM mon_submissions s LEFT JOIN mon_record_set cs ON cs.id = s.record_set_id AND s.deleted_date IS NULL AND s.reliability_check_of_submissions_id IS NULL
  LEFT JOIN mon_record_set ps ON ps.id = cs.sampled_from_id LEFT JOIN mon_submission_type st ON st.id = s.submission_type_id
  LEFT JOIN mon_submission_mode m ON m.id = s.submission_mode_id LEFT JOIN mon_location l ON l.id = st.location_id LEFT JOIN mon_program p ON p.id = l.program_id
  LEFT JOIN roster_year ry ON ry.id = s.roster_year_id
  WHERE ps.id IN (SELECT record_set_id FROM mon_record_attribute WHERE record_set_id IS NOT NULL))
"""
_native("picker_raw_data", _PARAMS + "SELECT DISTINCT roster_year FROM prm WHERE program IN ('Special Education') AND submission_mode IN ('Mode 1', 'Mode 5')",
        lambda t: PK.raw_data(t, "roster_year", program="Special Education", submission_mode=["Mode 1", "Mode 5"]))
_native("picker_record_sets", _PARAMS + "SELECT DISTINCT record_set_id AS id, location || ' > ' || submission_mode || ' > ' || record_set AS name FROM prm WHERE program = 'Special Education'",
        PK.record_sets)
_native("picker_years", """x AS (SELECT 1) SELECT DISTINCT ry.id, CAST(start_year AS VARCHAR) || '-' || right(CAST(start_year + 1 AS VARCHAR), 2) AS name
  FROM roster_year ry JOIN mon_submissions s ON s.roster_year_id = ry.id WHERE s.submission_type_id = 'ST1'""", lambda t: PK.years(t, "ST1"))
_native("picker_modes", """x AS (SELECT 1) SELECT DISTINCT m.id, m.name FROM mon_submissions s JOIN mon_submission_mode m ON m.id = s.submission_mode_id
  WHERE s.submission_type_id = 'ST1' AND s.roster_year_id = 'RY1997'""", lambda t: PK.modes(t, "ST1", "RY1997"))
_native("picker_live_submissions", """x AS (SELECT 1) SELECT org_unit_id, roster_year_id, count(*) AS n FROM mon_submissions
  WHERE deleted_date IS NULL AND reliability_check_of_submissions_id IS NULL GROUP BY 1, 2""", PK.live_submissions)
_native("picker_default_year", "x AS (SELECT 1) SELECT id, start_year FROM roster_year ORDER BY start_year, id LIMIT 1", PK.default_year)
_native("picker_last_years", "x AS (SELECT 1) SELECT DISTINCT start_year FROM roster_year ORDER BY start_year DESC LIMIT 3", PK.last_years)
_native("picker_sections", """d AS (SELECT DISTINCT ar.id AS section_id, ar.label AS section, CAST(ar.sequence AS INTEGER) AS section_sequence
  FROM items i JOIN form_template_layout p ON p.id = i.layout_parent_id LEFT JOIN mon_submission_area ar ON ar.form_template_control_id = p.control_id)
  SELECT * FROM d""", lambda t: PK.sections(t, None))
_native("picker_questions", """x AS (SELECT 1) SELECT DISTINCT attribute_id, code || ' ' || label AS name FROM items i JOIN mon_submission_type st ON st.form_template_id = i.template_id
  WHERE attribute_id IN ('I1', 'I3', 'IC1', 'IC2')""", lambda t: PK.questions(t, ["I1", "I3", "IC1", "IC2"]))
_native("picker_form_stats", """x AS (SELECT 1) SELECT template_id, template_name, count(DISTINCT attribute_id) AS attributes, count(DISTINCT m.name) AS modes
  FROM items i JOIN mon_submission_type st ON st.form_template_id = i.template_id LEFT JOIN mon_submission_mode m ON m.submission_type_id = st.id GROUP BY 1, 2""", PK.form_stats)


@query("picker_languages", C._FM + "SELECT DISTINCT language AS value FROM fm")
def picker_languages(spark, sf):
    """PQ7: languages of the family master."""
    return PK.values_of(C._master(spark, sf)[1], "language")


@query("cascading_picker", S.with_base() + f"SELECT DISTINCT district, school FROM inst WHERE au IN ('AMERICA', 'ASIA') AND (roster_year IS NULL OR roster_year = {YEAR})")
def cascading_picker(spark, sf):
    """PQ1 (FI1, FI7, AG17): the next choices left by the chosen organisations and year."""
    from ..functions import null_or_eq
    inst = proxy.instances(proxy.read_tables(spark, sf, C.ORDER_TABLES))
    return ME.dedupe(FI.keep_in(inst, "au", ["AMERICA", "ASIA"]).filter(null_or_eq("roster_year", YEAR)), ["district", "school"])


# -- sorts and levels ------------------------------------------------------------------
@query("top_n_rows", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25")
def top_n_rows(spark, sf):
    """SO2: the 25 dearest lines of the whole table."""
    li = proxy.read_tables(spark, sf, ("lineitem",))["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return RK.top_n(li, [F.col("l_extendedprice").desc(), *[F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]], 25)


@query("totals_last", f"SELECT * FROM ({C.ORACLE['rollup_by_dimension']}) WHERE au_sort_bit = 0 AND district_sort_bit = 1")
def totals_last(spark, sf):
    """SO1 + FI13: the AU level of the outcome rollup, details before totals."""
    rows = FI.keep_levels(C.QUERIES["rollup_by_dimension"](spark, sf), "top", ["au_sort_bit", "district_sort_bit"])
    return RK.sort_totals_last(rows, ["au_sort_bit", "district_sort_bit"], ["admin_unit", "district"])

