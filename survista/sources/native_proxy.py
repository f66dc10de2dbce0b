"""The native form and record store, shaped from the driver's test tables.

Each native table is one SELECT over the test tables, in SQL that Spark and
DuckDB both read, so that queries and oracles start from the same rows. The
SELECTs only give rows in the native schemas (``survista.schemas``); joining,
decoding, walking and pivoting them is the views' work.

* org unit = region (region 4 without a number), grants as in ``proxy``
* submission = region x order year x priority code (mode); submissions of
  region 3 in mode 5 are deleted, those of region 2 in mode 4 are checks
* record = order; excluded where the order status is P
* form instance = order; answer = lineitem (item = line number)
* layout = root > three sections > one area each; items 1-8 with types; and a
  register form for each region with an item at each customer
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES
from .proxy import GRANTS, ITEM_TYPES, QUESTION_WEIGHTS

_INST = ("{orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey "
         "JOIN {region} r ON n.n_regionkey = r.r_regionkey")
_SUB = "'S' || CAST(n_regionkey AS STRING) || '-' || CAST(year(o_orderdate) AS STRING) || '-' || substr(o_orderpriority, 1, 1)"
_VAL = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"


def _rows(rows, cols: str) -> str:
    def lit(v):
        return "NULL" if v is None else repr(v) if not isinstance(v, str) else "'" + v + "'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") AS v({cols})"


_TYPES = ("Text", "SingleSelect", "Date", "Flag", "MultiSelect")
# Fixed values of the stand-in form: item number, section, sequence in it, code, label, report label, weight.
_ITEMS = [(1, "A", 0, "Q1", "Question one", "One"), (2, "A", 1, "Q2", "Question two", None), (3, "A", 2, "Q3", "Question three", "Three"),
          (4, "B", 0, "Q4", "Question four", "Four"), (5, "B", 1, "Q5", "Question five", "SASID"), (6, "B", 2, "Q6", "Question six", "One"),
          (7, "C", 0, "Q7", "Question seven", None), (8, "C", 1, "Q8", "Question eight, never answered", "Eight")]
_ITEM_TYPE = {**dict(ITEM_TYPES), 8: "Text"}
_WEIGHT = {3: 2.0, 4: 1.5}
QUESTION_WEIGHT = {f"IQ{q}": w for q, w in QUESTION_WEIGHTS}
_RECORD_ATTRIBUTES = [("SASID", "CAST(o_orderkey AS STRING)"), ("District", "n_name"), ("School", "c_mktsegment"),
                      ("Disability", "substr(o_orderpriority, 1, 1)"), ("Year", "CAST(year(o_orderdate) AS STRING)")]

#: A further form for each region: its layout is region > nations > customers, with an item at each customer. Its
#: rows follow the columns of the tables below.
_FORMS = {
    "mon_submission_type": "SELECT 'STR' || CAST(r_regionkey AS STRING), 'Register', 'L1', 'TR' || CAST(r_regionkey AS STRING) FROM {region}",
    "mon_submission_mode": "SELECT 'MR' || CAST(r_regionkey AS STRING), 'Register mode', 'STR' || CAST(r_regionkey AS STRING) FROM {region}",
    "form_template": "SELECT 'TR' || CAST(r_regionkey AS STRING), 'Register ' || r_name FROM {region}",
    "form_template_layout":
        "SELECT 'LR' || CAST(r_regionkey AS STRING), 'TR' || CAST(r_regionkey AS STRING), 'R' || CAST(r_regionkey AS STRING), NULL, CAST(r_regionkey AS INT) FROM {region} "
        "UNION ALL SELECT 'LN' || CAST(n_nationkey AS STRING), 'TR' || CAST(n_regionkey AS STRING), 'N' || CAST(n_nationkey AS STRING), 'LR' || CAST(n_regionkey AS STRING), "
        "CAST(n_nationkey AS INT) FROM {nation} "
        "UNION ALL SELECT 'LC' || CAST(c_custkey AS STRING), 'TR' || CAST(n_regionkey AS STRING), 'C' || CAST(c_custkey AS STRING), 'LN' || CAST(n_nationkey AS STRING), "
        "CAST(c_custkey % 50 AS INT) FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey",
    "form_template_control": "SELECT 'C' || CAST(c_custkey AS STRING), 'CT1', false FROM {customer}",
    "form_template_input_item": "SELECT 'IC' || CAST(c_custkey AS STRING), 'C' || CAST(c_custkey AS STRING), 'TYText', CAST(c_custkey % 7 AS INT), 'C' || CAST(c_custkey AS STRING), "
                                "c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, NULL FROM {customer}",
    "mon_submission_area": "SELECT 'ARN' || CAST(n_nationkey AS STRING), n_name, 'N' || CAST(n_nationkey AS STRING), 'STR' || CAST(n_regionkey AS STRING), CAST(n_nationkey AS INT) FROM {nation}",
}

#: SELECT of each native table; {name} stands for a test table.
STORE: dict[str, str] = {
    "org_unit": "SELECT 'OU' || CAST(r_regionkey AS STRING) AS id, r_name AS name, "
                "CASE WHEN r_regionkey < 4 THEN CAST(100 + r_regionkey AS STRING) END AS number FROM {region}",
    "user_profile_org_unit": _rows([(u, f"OU{o}") for u, o in GRANTS], "user_profile_id, org_unit_id"),
    "roster_year": "SELECT DISTINCT 'RY' || CAST(year(o_orderdate) AS STRING) AS id, CAST(year(o_orderdate) AS INT) AS start_year FROM {orders}",
    "mon_program": _rows([("P1", "Special Education")], "id, display_name"),
    "mon_location": _rows([("L1", "P1", "Location one", 1)], "id, program_id, display_name, sequence"),
    "mon_submission_type": _rows([("ST1", "Survey", "L1", "T1")], "id, name, location_id, form_template_id"),
    "mon_submission_mode": _rows([(f"M{m}", f"Mode {m}", "ST1") for m in range(1, 6)], "id, name, submission_type_id"),
    "mon_submissions": f"SELECT {_SUB} AS id, 'OU' || CAST(n_regionkey AS STRING) AS org_unit_id, "
                       "'RY' || CAST(year(o_orderdate) AS STRING) AS roster_year_id, 'ST1' AS submission_type_id, "
                       "'M' || substr(o_orderpriority, 1, 1) AS submission_mode_id, 'RS1' AS record_set_id, "
                       "min(o_orderdate) AS started_date, max(o_orderdate) AS closed_date, "
                       "max(CASE WHEN n_regionkey = 3 AND substr(o_orderpriority, 1, 1) = '5' THEN o_orderdate END) AS deleted_date, "
                       "max(CASE WHEN n_regionkey = 2 AND substr(o_orderpriority, 1, 1) = '4' THEN 'S0' END) AS reliability_check_of_submissions_id "
                       f"FROM {_INST} GROUP BY n_regionkey, year(o_orderdate), substr(o_orderpriority, 1, 1)",
    "mon_submission_record": f"SELECT 'SR' || CAST(o_orderkey AS STRING) AS id, {_SUB} AS submissions_id, "
                             f"'SEL' || CAST(o_orderkey AS STRING) AS record_selection_id, CAST(o_orderkey % 7 AS INT) AS sequence_number FROM {_INST}",
    "mon_submission_record_form": "SELECT 'F' || CAST(o_orderkey AS STRING) AS id, 'SR' || CAST(o_orderkey AS STRING) AS submission_record_id FROM {orders}",
    "mon_record_set": _rows([("RS0", "Records", None), ("RS1", "Sample", "RS0")], "id, name, sampled_from_id"),
    "mon_record": "SELECT 'R' || CAST(o_orderkey AS STRING) AS id, 'RS0' AS record_set_id, CAST(o_orderkey AS STRING) AS search_key FROM {orders}",
    "mon_record_selection": "SELECT 'SEL' || CAST(o_orderkey AS STRING) AS id, 'R' || CAST(o_orderkey AS STRING) AS record_id, 'RS1' AS record_set_id, "
                            "CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS excluded_date FROM {orders}",
    "mon_record_attribute": _rows([(f"A{i}", name, "RS0", i) for i, (name, _) in enumerate(_RECORD_ATTRIBUTES)], "id, name, record_set_id, sequence_number"),
    "mon_record_attribute_value": " UNION ALL ".join(
        f"SELECT 'R' || CAST(o_orderkey AS STRING) AS record_id, 'A{i}' AS attribute_id, {value} AS value FROM {_INST}"
        for i, (_, value) in enumerate(_RECORD_ATTRIBUTES)),
    "form_template": _rows([("T1", "Template one")], "id, name"),
    "form_template_layout": _rows([("LY0", "T1", "C0", None, 1), *[(f"LY{s}", "T1", f"C{s}", "LY0", k) for k, s in enumerate("ABC")],
                                   *[(f"LY{s}1", "T1", f"C{s}1", f"LY{s}", 10) for s in "ABC"]], "id, template_id, control_id, parent_id, sequence"),
    "form_template_control": _rows([(c, "CT0" if len(c) == 2 else "CT1", False) for c in ("C0", "CA", "CB", "CC", "CA1", "CB1", "CC1")],
                                   "id, type_id, is_repeatable"),
    "form_template_control_type": _rows([("CT0", "Section"), ("CT1", "Input area")], "id, name"),
    "form_template_control_property": _rows([("CA1", "Level", "1"), ("CA1", "Style", "wide"), ("CB1", "Style", "sparse"), ("CC1", "Style", "a"), ("CC1", "Hint", "b")],
                                            "control_id, name, value"),
    "form_template_input_item_type": _rows([(f"TY{x}", x) for x in _TYPES], "id, name"),
    "form_template_input_item": _rows([(f"I{i}", f"C{s}1", f"TY{_ITEM_TYPE[i]}", q, code, label, report, _WEIGHT.get(i)) for i, s, q, code, label, report in _ITEMS],
                                      "id, input_area_id, type_id, sequence, code, label, report_label, report_weight"),
    "form_template_input_select_field_option": "SELECT DISTINCT 'O' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING) AS id, "
        "CASE CAST(ceil(l_quantity / 10) AS INT) WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' ELSE 'Option ' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING) END AS label, "
        "CASE CAST(ceil(l_quantity / 10) AS INT) WHEN 1 THEN 'Met' WHEN 2 THEN 'Not Met' WHEN 3 THEN 'Not Applicable' END AS report_label, "
        "CAST(ceil(l_quantity / 10) - 1 AS INT) AS sequence FROM {lineitem}",
    "form_instance": "SELECT 'F' || CAST(o_orderkey AS STRING) AS id, 'T1' AS template_id FROM {orders}",
    "form_instance_interval": "SELECT 'N' || CAST(o_orderkey AS STRING) AS id, 'F' || CAST(o_orderkey AS STRING) AS instance_id FROM {orders}",
    "form_input_value": f"SELECT DISTINCT {_VAL} AS id, 'N' || CAST(l_orderkey AS STRING) AS interval_id, 'I' || CAST(l_linenumber AS STRING) AS input_field_id FROM {{lineitem}}",
    "form_input_text_value": f"SELECT {_VAL} AS id, min('<p>' || l_returnflag || ';</p>') AS value FROM {{lineitem}} WHERE l_linenumber IN (1, 2) GROUP BY {_VAL}",
    "form_input_single_select_value": f"SELECT {_VAL} AS id, min('O' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING)) AS selected_option_id "
                                      f"FROM {{lineitem}} WHERE l_linenumber IN (3, 4) AND l_returnflag <> 'N' GROUP BY {_VAL}",
    "form_input_date_value": f"SELECT {_VAL} AS id, min(l_shipdate) AS value FROM {{lineitem}} WHERE l_linenumber = 5 GROUP BY {_VAL}",
    "form_input_flag_value": f"SELECT {_VAL} AS id, min(l_linestatus) = 'F' AS value FROM {{lineitem}} WHERE l_linenumber = 6 GROUP BY {_VAL}",
    "mon_submission_area": _rows([(f"AR{s}", f"Area {s}", f"C{s}", "ST1", k) for k, s in enumerate("CAB")], "id, label, form_template_control_id, submission_type_id, sequence"),
    "mon_submission_item": _rows([("MI1", "ARA", "Item one", "I1", 1), ("MI3", "ARA", "Item three", "I3", 2), ("MI3b", "ARB", "Item three again", "I3", 3)],
                                 "id, submission_area_id, label, form_template_input_item_id, sequence"),
}

STORE.update({name: f"{STORE[name]} UNION ALL {text}" for name, text in _FORMS.items()})


# Fixed values of the stand-in family survey: items of the three read areas (layout sequences 0, 2, 4) and of one that only
# the all-blank rule looks at, two of which every view leaves out.
_FAMILY_ITEMS = [("ILANG", "CFL", 0, "LANG", "Language", None), ("IMATCH", "CFM", 0, "MATCH", "Disability match", None),
                 *[(f"IQ{q}", "CFQ", q - 1, f"F{q}", f"Question {text}", "Short " + text)
                   for q, text in enumerate(("one", "two", "three", "four", "five", "six", "seven"), 1)],
                 ("INOTE", "CFX", 0, "NOTE", "Note", None), ("IDROP1", "CFX", 1, "D1", "Dropped one", None), ("IDROP2", "CFX", 2, "D2", "Dropped two", None)]
_FAMILY_OPTIONS = [*[(f"O{k}", f"{k} of 5", k - 1, None) for k in range(1, 6)], ("OEN", "English", 0, None), ("OES", "Spanish", 1, None),
                   ("OYES", "Yes", 0, None), ("ONO", "No", 1, None), ("OOLD", "Old answer", 2, "2001-01-01"), ("OC", "Noted", 0, None)]
_KEY = "CAST(o_orderkey AS STRING)"
_FAMILY_ATTRIBUTES = [("A1", "n_name", "o_custkey % 11 <> 0"), ("A2", "c_mktsegment", "true"), ("A3", "lpad(CAST(o_custkey % 18 AS STRING), 2, '0')", "o_custkey % 18 <> 17"),
                      ("A5", "lpad(CAST(o_orderkey % 10 AS STRING), 3, '0')", "true"), ("A0", "'unused'", "true")]

#: The family survey's record attributes from one read of the records: the rows of its SQL, which reads them once for each attribute.
_FAMILY_ATTRIBUTE_ROWS = (f"SELECT 'R' || {_KEY} AS record_id, a.attribute_id, a.value FROM {_INST} LATERAL VIEW inline(array("
                          + ", ".join(f"struct('{a}' AS attribute_id, {value} AS value, {cond} AS there)" for a, value, cond in _FAMILY_ATTRIBUTES)
                          + ")) a AS attribute_id, value, there WHERE a.there")

#: The family survey's answers and chosen options in parts: test table, the id of its rows, and the SELECT.
_FAMILY_ANSWERS = {
    "form_input_value": [
        ("lineitem", _VAL, f"SELECT DISTINCT {_VAL} AS id, 'N' || CAST(l_orderkey AS STRING) AS interval_id, 'IQ' || CAST(l_linenumber AS STRING) AS input_field_id FROM {{lineitem}}"),
        *[("orders", f"'{p}' || {_KEY}", f"SELECT '{p}' || {_KEY}, 'N' || {_KEY}, '{i}' FROM {{orders}}")
          for p, i in (("VL", "ILANG"), ("VM", "IMATCH"), ("VC", "INOTE"), ("VD", "IDROP1"))]],
    "form_input_single_select_value": [
        ("lineitem", _VAL, f"SELECT {_VAL} AS id, min('O' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING)) AS selected_option_id FROM {{lineitem}} WHERE l_returnflag <> 'N' GROUP BY {_VAL}"),
        ("orders", f"'VL' || {_KEY}", f"SELECT 'VL' || {_KEY}, CASE WHEN o_custkey % 4 = 1 THEN 'OES' ELSE 'OEN' END FROM {{orders}} WHERE o_custkey % 4 <> 3"),
        ("orders", f"'VM' || {_KEY}", f"SELECT 'VM' || {_KEY}, CASE o_orderkey % 3 WHEN 0 THEN 'OYES' WHEN 1 THEN 'ONO' ELSE 'OOLD' END FROM {{orders}}"),
        *[("orders", f"'{p}' || {_KEY}", f"SELECT '{p}' || {_KEY}, 'OC' FROM {{orders}}") for p in ("VC", "VD")]],
}

#: The id by which the views join these tables, dealt out as the answers are.
_FAMILY_DEALT = {"mon_submission_record_form": f"'SR' || {_KEY}", "mon_record_selection": f"'SEL' || {_KEY}", "form_instance_interval": f"'F' || {_KEY}"}

#: A family survey: type ST1 outside mode M5, form TF. Some records lack a district or disability; language and match are answers of the
#: form, missing or of a deleted option for some; some forms are blank but for their note.
FAMILY: dict[str, str] = {
    **{n: STORE[n] for n in ("org_unit", "user_profile_org_unit", "mon_submissions", "mon_submission_record", "mon_submission_record_form", "mon_record",
                             "mon_record_selection", "form_instance_interval")},
    "roster_year": "SELECT DISTINCT 'RY' || CAST(year(o_orderdate) AS STRING) AS id, CAST(year(o_orderdate) AS INT) AS start_year, "
                   "make_date(year(o_orderdate), 7, 1) AS start_date, make_date(year(o_orderdate) + 1, 6, 30) AS end_date FROM {orders}",
    "mon_record_attribute_value": " UNION ALL ".join(f"SELECT 'R' || {_KEY} AS record_id, '{a}' AS attribute_id, {value} AS value FROM {_INST} WHERE {cond}"
                                                     for a, value, cond in _FAMILY_ATTRIBUTES),
    "form_template_layout": _rows([("LF0", "TF", "CF0", None, 9), *[(f"LF{a}", "TF", f"CF{a}", "LF0", k) for a, k in (("L", 0), ("M", 2), ("Q", 4), ("X", 6))]],
                                  "id, template_id, control_id, parent_id, sequence"),
    "form_template_input_item": _rows([(i, area, "TYSingleSelect", k, code, label, short, QUESTION_WEIGHT.get(i)) for i, area, k, code, label, short in _FAMILY_ITEMS],
                                      "id, input_area_id, type_id, sequence, code, label, report_label, report_weight"),
    "form_template_input_select_field_option": _rows(_FAMILY_OPTIONS, "id, label, sequence, deleted_date"),
    **{n: " UNION ALL ".join(text for _, _, text in parts) for n, parts in _FAMILY_ANSWERS.items()},
}


#: The store with a form of single-select items alone, as a checklist has them.
CHECKLIST: dict[str, str] = {
    **STORE,
    "form_template_input_item": _rows([(f"I{i}", f"C{s}1", "TYSingleSelect", q, code, label, report, None) for i, s, q, code, label, report in _ITEMS],
                                      "id, input_area_id, type_id, sequence, code, label, report_label, report_weight"),
    "form_input_single_select_value": f"SELECT {_VAL} AS id, min('O' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING)) AS selected_option_id "
                                      f"FROM {{lineitem}} WHERE l_linestatus <> 'O' OR l_linenumber > 2 GROUP BY {_VAL}",
}

# Fixed values of the stand-in tracked program: three forms, of which the first asks for help, the second asks and has two review
# dates, and the third does neither.
_TRACKED_ITEMS = [("IG1", "TG1", "SingleSelect", "H1", "Do you need Assistance with the budget?"), ("IG2", "TG1", "Text", "Q2", "Other question"),
                  ("IG3", "TG2", "SingleSelect", "H2", "request ASSISTANCE now"), ("IG4", "TG2", "Date", "Rev1", "Review Date 1 (4 months after submission):"),
                  ("IG5", "TG2", "Date", "Rev2", "Review Date 2 (8 months after submission):"), ("IG6", "TG3", "Text", "Q6", "Plain question")]
_MODE = "substr(o_orderpriority, 1, 1)"
_TRACKED_ITEM = (f"CASE WHEN {_MODE} = '3' THEN CASE l_linenumber WHEN 1 THEN 'IG3' WHEN 2 THEN 'IG4' WHEN 3 THEN 'IG5' ELSE 'IG6' END "
                 f"WHEN {_MODE} = '5' THEN 'IG6' ELSE CASE l_linenumber WHEN 1 THEN 'IG1' ELSE 'IG2' END END")

#: A tracked program PG: modes MG1-MG5 of three types at two locations; region 4 is a test organisation, region 1 never closes.
TRACKED: dict[str, str] = {
    **{n: STORE[n] for n in ("user_profile_org_unit", "roster_year", "mon_submission_record", "mon_submission_record_form", "form_instance_interval",
                             "form_template_input_item_type", "form_template_control_type")},
    "org_unit": "SELECT 'OU' || CAST(r_regionkey AS STRING) AS id, CASE WHEN r_regionkey = 4 THEN 'TEST AU' ELSE r_name END AS name, 'X' AS number FROM {region}",
    "mon_location": _rows([("LG1", "PG", "Profile", 2), ("LG2", "PG", "Improvement", 1), ("LX", "PX", "Other", 3)], "id, program_id, display_name, sequence"),
    "mon_submission_type": _rows([("STG1", "Annual", "LG1", "TG1"), ("STG2", "Timeline", "LG2", "TG2"), ("STG3", "Silent", "LG1", "TG3"), ("STX", "Other", "LX", "TG1")],
                                 "id, name, location_id, form_template_id"),
    "mon_submission_mode": _rows([("MG1", "Annual Budget Review", "STG1"), ("MG2", "AU Budget: Zero", "STG1"), ("MG3", "Improvement Timeline", "STG2"),
                                  ("MG4", "Worksheet", "STG1"), ("MG5", "Silent mode", "STG3"), ("MX", "Other mode", "STX")], "id, name, submission_type_id"),
    "mon_submissions": f"SELECT {_SUB} AS id, 'OU' || CAST(n_regionkey AS STRING) AS org_unit_id, 'RY' || CAST(year(o_orderdate) AS STRING) AS roster_year_id, "
                       f"CASE {_MODE} WHEN '3' THEN 'STG2' WHEN '5' THEN 'STG3' ELSE 'STG1' END AS submission_type_id, 'MG' || {_MODE} AS submission_mode_id, "
                       "min(o_orderdate) AS started_date, max(CASE WHEN n_regionkey <> 1 THEN o_orderdate END) AS closed_date, "
                       f"max(CASE WHEN n_regionkey = 3 AND {_MODE} = '1' THEN o_orderdate END) AS deleted_date, "
                       f"max(CASE WHEN n_regionkey = 2 AND {_MODE} = '3' THEN 'S0' END) AS reliability_check_of_submissions_id "
                       f"FROM {_INST} GROUP BY n_regionkey, year(o_orderdate), {_MODE}",
    "form_template": _rows([(f"TG{k}", f"Tracked {k}") for k in (1, 2, 3)], "id, name"),
    "form_template_layout": _rows([r for k in (1, 2, 3) for r in ((f"LT{k}", f"TG{k}", f"CT{k}", None, 1), (f"LA{k}", f"TG{k}", f"CG{k}", f"LT{k}", 1))],
                                  "id, template_id, control_id, parent_id, sequence"),
    "form_template_control": _rows([(f"CG{k}", "CT1", False) for k in (1, 2, 3)], "id, type_id, is_repeatable"),
    "form_template_input_item": _rows([(i, "C" + f[1:], f"TY{kind}", n, code, label) for n, (i, f, kind, code, label) in enumerate(_TRACKED_ITEMS)],
                                      "id, input_area_id, type_id, sequence, code, label"),
    "form_template_input_select_field_option": _rows([(f"O{k}", f"Help {k}", k) for k in range(1, 6)], "id, label, sequence"),
    "form_instance": f"SELECT 'F' || {_KEY} AS id, CASE {_MODE} WHEN '3' THEN 'TG2' WHEN '5' THEN 'TG3' ELSE 'TG1' END AS template_id FROM {{orders}}",
    "form_input_value": f"SELECT DISTINCT {_VAL} AS id, 'N' || CAST(l_orderkey AS STRING) AS interval_id, {_TRACKED_ITEM} AS input_field_id "
                        "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
    "form_input_single_select_value": f"SELECT {_VAL} AS id, min('O' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING)) AS selected_option_id "
                                      f"FROM {{lineitem}} WHERE l_linenumber = 1 AND l_returnflag <> 'N' GROUP BY {_VAL}",
}


def _dealt(spark: SparkSession, t: dict[str, DataFrame], parts: list[tuple[str, str, str]]) -> DataFrame:
    """The union of ``parts``, with the test tables' rows dealt out by the id that a part gives them: its own grouping and the
    joins by id need no further exchange, and keys are exchanged instead of the texts made of them."""
    return reduce(DataFrame.unionAll, [spark.sql(text, **{name: t[name].repartition(F.expr(key))}) for name, key, text in parts])


def store(spark: SparkSession, t: dict[str, DataFrame], texts: dict[str, str] = STORE) -> dict[str, DataFrame]:
    """The native tables over the test tables ``t``, in the declared schemas."""
    out = {}
    for name, text in texts.items():
        used = {k: v for k, v in t.items() if "{" + k + "}" in text}
        if texts is FAMILY and name in _FAMILY_ANSWERS:
            df = _dealt(spark, t, _FAMILY_ANSWERS[name])
        elif texts is FAMILY and name in _FAMILY_DEALT:
            df = _dealt(spark, t, [("orders", _FAMILY_DEALT[name], text)])
        elif texts is FAMILY and name == "mon_record_attribute_value":
            df = spark.sql(_FAMILY_ATTRIBUTE_ROWS, **used)
        else:
            df = spark.sql(text, **used) if used else spark.sql(text)
        out[name] = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
    return out


def ctes(*names: str, texts: dict[str, str] = STORE) -> str:
    """The native tables as DuckDB common table expressions."""
    plain = {k: k for k in ("region", "nation", "customer", "orders", "lineitem")}
    return ",\n".join(f"{n} AS ({texts[n].format(**plain)})" for n in names or texts)
