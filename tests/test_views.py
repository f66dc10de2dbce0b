"""Native-schema views on a tiny hand-made store."""

import datetime as dt

import pytest

from survista.plans.views import compliance_formlet_attributes, formlet_columns, formlet_kav, raw_data_by_record_set, record_kav
from survista.schemas import TABLES

D = dt.datetime(2015, 9, 1)
ROWS = {
    "org_unit": [("OU1", "Unit One", None)],
    "user_profile_org_unit": [("U1", "OU1")],
    "roster_year": [("RY1", 2015, dt.date(2015, 7, 1), dt.date(2016, 6, 30))],
    "mon_location": [("L1", "P1", "Loc", 1)],
    "mon_submission_type": [("ST1", "Type", "L1", "T1")],
    "mon_submission_mode": [("M1", "Mode", "ST1")],
    "mon_submissions": [("S1", "OU1", "RY1", "ST1", "M1", "RS1", D, None, None, None),
                        ("S2", "OU1", "RY1", "ST1", "M1", "RS1", D, None, D, None)],
    "mon_submission_record": [("SR1", "S1", "SEL1", 0), ("SR2", "S2", "SEL1", 1)],
    "mon_submission_record_form": [("F1", "SR1"), ("F2", "SR2")],
    "mon_record_set": [("RS1", "Set", None)],
    "mon_record": [("R1", "RS1", "123")],
    "mon_record_selection": [("SEL1", "R1", "RS1", None)],
    "mon_record_attribute": [("A1", "SASID", "RS1", 1)],
    "mon_record_attribute_value": [("R1", "A1", "123")],
    "form_template": [("T1", "Template")],
    "form_template_layout": [("LY1", "T1", "C1", None, 1), ("LY2", "T1", "C2", "LY1", 2)],
    "form_template_input_item": [("I1", "C2", "TS", 1, "q1", "Q one", None, 2.0),
                                 ("I2", "C2", "TT", 2, "q2", "Q two", "Two", None),
                                 ("I3", "C2", "TD", 3, "q3", "Q three", None, None),
                                 ("I4", "C2", "TF", 4, "q4", "Q four", None, None)],
    "form_template_input_item_type": [("TS", "SingleSelect"), ("TT", "Text"), ("TD", "Date"), ("TF", "Flag")],
    "form_template_input_select_field_option": [("O0", "I1", "Never", None, 0, None),
                                                ("O1", "I1", "Often", "Often!", 1, None)],
    "form_instance": [("F1", "T1"), ("F2", "T1")],
    "form_instance_interval": [("INT1", "F1"), ("INT2", "F2")],
    "form_input_value": [("V1", "INT1", "I1"), ("V2", "INT1", "I2"), ("V3", "INT1", "I3"), ("V4", "INT1", "I4"),
                         ("V5", "INT2", "I1")],
    "form_input_text_value": [("V2", "a<p>b;\r\nc")],
    "form_input_single_select_value": [("V1", "O1"), ("V5", "O0")],
    "form_input_date_value": [("V3", dt.datetime(2016, 2, 3))],
    "form_input_flag_value": [("V4", True)],
}


@pytest.fixture(scope="module")
def t(spark):
    return {n: spark.createDataFrame(ROWS.get(n, []), TABLES[n]) for n in TABLES}


def test_record_kav_live_only(t):
    rows = record_kav(t).collect()
    assert [(r.instance_id, r.attribute, r.value, r.au_code, r.roster_year, r.submission_sequence)
            for r in rows] == [("F1", "SASID", "123", "Blank", "2015-16", 1)]


def test_formlet_columns_sequence(t):
    got = [(r.attribute_id, r.display_sequence, r.attribute_sequence)
           for r in formlet_columns(t).orderBy("attribute_sequence").collect()]
    assert got == [("I1", "101_102_101", 1), ("I2", "101_102_102", 2), ("I3", "101_102_103", 3),
                   ("I4", "101_102_104", 4)]


def test_formlet_kav_typed_and_scored(t):
    got = sorted((r.instance_id, r.attribute_code, r.value) for r in formlet_kav(t).collect())
    assert got == [("F1", "Lq1", "2"), ("F1", "Wq1", "4"), ("F1", "q1", "Often!"), ("F1", "q2", "a<p>b;\r\nc"),
                   ("F1", "q3", "02/03/2016"), ("F1", "q4", "1"),
                   ("F2", "Lq1", "1"), ("F2", "Wq1", "2"), ("F2", "q1", "Never")]


def test_formlet_kav_field_label_is_the_typed_value(t):
    got = {(r.instance_id, r.attribute_code): r.select_field_label for r in formlet_kav(t).collect()}
    assert got["F1", "q1"] == "Often" and got["F1", "q2"] == "a<p>b;\r\nc" and got["F1", "q3"] == "02/03/2016" and got["F1", "q4"] == "1"
    assert got["F1", "Wq1"] == "Often"


def test_raw_data_wide_rows(spark, t):
    more = dict(t)
    def add(name, *rows):
        more[name] = more[name].union(spark.createDataFrame(list(rows), TABLES[name]))
    add("mon_record_set", ("RS0", "Parent", None))
    more["mon_record_set"] = more["mon_record_set"].selectExpr("id", "name", "IF(id = 'RS1', 'RS0', NULL) AS sampled_from_id")
    more["mon_record"] = spark.createDataFrame([("R1", "RS0", "123"), ("R2", "RS0", "456")], TABLES["mon_record"])
    more["mon_record_attribute"] = spark.createDataFrame([("A1", "SASID", "RS0", 1)], TABLES["mon_record_attribute"])
    add("mon_record_attribute_value", ("R2", "A1", "456"))
    add("mon_record_selection", ("SEL2", "R2", "RS1", D))
    add("mon_submission_record", ("SR3", "S1", "SEL2", 5))
    add("mon_submission_record_form", ("F3", "SR3"))
    add("form_instance", ("F3", "T1"))
    add("form_template_input_item", ("I5", "C2", "TT", 5, "q5", "Q five", "SASID", None))
    rows = [r.asDict() for r in raw_data_by_record_set(more, "U1", "RS0").orderBy("submission_sequence").collect()]
    assert rows == [
        {"AU": "Unit One", "SASID2": "123", "submission_sequence": 0, "is_excluded": 0, "SASID": "123", "q1": "Often", "Two": "abc",
         "q3": "02/03/2016", "q4": "1", "SASID_2": None},
        {"AU": "Unit One", "SASID2": "456", "submission_sequence": 5, "is_excluded": 1, "SASID": "456", "q1": None, "Two": None,
         "q3": None, "q4": None, "SASID_2": None}]
    assert raw_data_by_record_set(more, "U2", "RS0").count() == 0


def test_compliance_attributes_note_is_last(spark, t):
    more = dict(t)
    more["mon_submission_area"] = spark.createDataFrame([("AR", "Area", "C1", "ST1", 7)], TABLES["mon_submission_area"])
    got = sorted((r.sequence, r.attribute_id, r.section, r.section_sequence, r.is_note) for r in compliance_formlet_attributes(more, "T1").collect())
    assert got == [(1, "I1", "Area", 7, 0), (2, "I2", "Area", 7, 0), (3, "I3", "Area", 7, 0), (4, "I4", "Area", 7, 1)]


def test_columns_fan_out_by_property_and_submission_item(spark, t):
    more = dict(t)
    more["form_template_control_property"] = spark.createDataFrame(
        [("C2", "Level", "1"), ("C2", "Style", "sparse"), ("C2", "Style", "x"), ("C2", "Hint", "y")], TABLES["form_template_control_property"])
    more["mon_submission_item"] = spark.createDataFrame([("M1", "AR", "one", "I1", 1)], TABLES["mon_submission_item"])
    got = sorted((r.attribute_id, r.control_property) for r in formlet_columns(more).collect())
    assert got == sorted((i, p) for i in ("I1", "I2", "I3", "I4") for p in ("Style", "Hint"))
