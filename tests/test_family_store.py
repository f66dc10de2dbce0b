"""The family survey over a small native store, and the plan of its master."""

import datetime as dt
import os

import pytest

from survista.plans import catalog  # noqa: F401  (imports the query modules in order)
from survista.plans import family_queries as FQ
from survista.plans import family_store as FS
from survista.schemas import TABLES

ATTRIBUTES = {"district": "AD", "school": "AS", "disability": "AX", "grade": "AG"}
ROWS = {
    "org_unit": [("OU1", "Unit One", None)],
    "roster_year": [("RY1", 2015, None, None)],
    "mon_submissions": [("S1", "OU1", "RY1", "STF", "M1", "RS", None, None, None, None), ("S2", "OU1", "RY1", "STF", "OUT", "RS", None, None, None, None),
                        ("S3", "OU1", "RY1", "ST", "M1", "RS", None, None, None, None)],
    "mon_submission_record": [(f"SR{i}", "S2" if i == 7 else "S3" if i == 8 else "S1", f"SEL{i}", i) for i in range(1, 9)],
    "mon_submission_record_form": [(f"F{i}", f"SR{i}") for i in range(1, 9)],
    "mon_record": [(f"R{i}", "RS", f"key{i}") for i in range(1, 9)],
    "mon_record_selection": [(f"SEL{i}", f"R{i}", "RS", None) for i in range(1, 9)],
    "mon_record_attribute_value": [("R1", "AD", "District"), ("R1", "AX", "03"), ("R1", "AG", "007"), ("R2", "AX", "99"), ("R1", "other", "x")],
    "form_template_layout": [("L0", "TF", "CL", None, 0), ("L2", "TF", "CM", None, 2), ("L4", "TF", "CQ", None, 4), ("L6", "TF", "CX", None, 6),
                             ("LZ", "TZ", "CZ", None, 4)],
    "form_template_input_item": [("IL", "CL", "T", 0, "L", "Language", None, None), ("IM", "CM", "T", 0, "M", "Match", None, None),
                                 ("Q1", "CQ", "T", 0, "q1", "One", None, 2.0), ("Q2", "CQ", "T", 1, "q2", "Two", None, None),
                                 ("NOTE", "CX", "T", 0, "n", "Note", None, None), ("DROP", "CQ", "T", 2, "d", "Drop", None, 1.0),
                                 ("QZ", "CZ", "T", 0, "z", "Other form", None, 1.0)],
    "form_template_input_select_field_option": [("EN", None, "English", None, 0, None), ("ES", None, "Spanish", None, 1, None), ("Y", None, "Yes", None, 0, None),
                                                ("A", None, "Always", None, 4, None), ("GONE", None, "Gone", None, 4, dt.datetime(2015, 1, 1))],
    "form_instance_interval": [(f"N{i}", f"F{i}") for i in range(1, 9)],
}
# instance, item, option: 1 answers all; 2 only blanks and a note; 3 a language only; 4 two languages; 5 only a note; 6 nothing
ANSWERS = [(1, "IL", "EN"), (1, "IM", "Y"), (1, "Q1", "A"), (1, "Q2", "A"), (1, "DROP", "A"), (1, "QZ", "A"), (2, "Q1", None), (2, "IL", "GONE"), (2, "NOTE", "A"),
           (3, "IL", "ES"), (4, "IL", "EN"), (4, "IL", "ES"), (4, "Q1", "A"), (5, "NOTE", "A"), (7, "Q1", "A"), (8, "Q1", "A")]


@pytest.fixture(scope="module")
def t(spark):
    rows = dict(ROWS)
    rows["form_input_value"] = [(f"V{k}", f"N{i}", q) for k, (i, q, _) in enumerate(ANSWERS)]
    rows["form_input_single_select_value"] = [(f"V{k}", o) for k, (_, _, o) in enumerate(ANSWERS) if o]
    return {n: spark.createDataFrame(rows.get(n, []), TABLES[n]) for n in TABLES}


def master(t, **kw):
    return FS.master(t, "STF", "TF", ATTRIBUTES, outside=["OUT"], dropped=["DROP"], ignored="NOTE", **kw)


def test_submissions_blank_and_decoded(t):
    got = {r.instance_id: (r.district, r.school, r.disability, r.disab, r.grade, r.search_key, r.roster_year)
           for r in FS.submissions(t, "STF", ATTRIBUTES, outside=["OUT"]).collect()}
    assert got["F1"] == ("District", "Blank", "03", "SED", "007", "key1", "2015-16")
    assert got["F2"] == ("Blank", "Blank", "99", "99", "Blank", "key2", "2015-16")
    assert sorted(got) == ["F1", "F2", "F3", "F4", "F5", "F6"]


def test_all_blank_instances_leave_the_responses(t):
    got = sorted((r.instance_id, r.attribute_id, r.response) for r in FS.responses(t, "TF", ["DROP"], "NOTE").collect())
    assert not [g for g in got if g[0] == "F2"]  # its only answer is the one that does not count
    assert ("F5", "NOTE", "Noted") not in got and ("F5", "NOTE", "Always") in got  # no other answer, so not all blank
    assert sorted(g[1] for g in got if g[0] == "F1") == ["IL", "IM", "Q1", "Q2"]
    assert any(r.instance_id == "F2" for r in FS.responses(t, "TF", ["DROP"]).collect())  # without the rule the note counts


def test_master_takes_sides_from_the_instance(t):
    got = sorted((r.instance_id, r.question or 0, r.language, r.disability_match, r.likert_score or 0, r.weighted_score or 0.0, r.likert75, r.grade)
                 for r in master(t, likert75_min=2).collect())
    assert got == [("F1", 1, "English", "Yes", 5, 10.0, 0, "006,007"), ("F1", 2, "English", "Yes", 0, 0.0, 0, "006,007"),
                   ("F2", 0, "Blank", "Blank", 0, 0.0, 0, "Blank"), ("F3", 0, "Spanish", "Blank", 0, 0.0, 0, "Blank"),
                   ("F4", 1, "English", "Blank", 5, 10.0, 1, "Blank"), ("F4", 1, "Spanish", "Blank", 5, 10.0, 1, "Blank"),
                   ("F5", 0, "Blank", "Blank", 0, 0.0, 0, "Blank"), ("F6", 0, "Blank", "Blank", 0, 0.0, 0, "Blank")]


def test_master_with_one_row_shows_the_same(t):
    """Without value ids: the same rows, and one for an instance whose only value comes twice (F11, F12)."""
    rows = lambda m: sorted(map(str, m.drop("layout_sequence").collect()))
    assert rows(master(t, likert75_min=2, one_row=True)) == rows(master(t, likert75_min=2))
    twice = {**t, "form_input_value": t["form_input_value"].union(t["form_input_value"].filter("interval_id IN ('N3', 'N5')"))}
    count = lambda m: {r.instance_id: r["count"] for r in m.groupBy("instance_id").count().collect()}
    assert count(master(twice, one_row=True)) == {"F1": 2, "F2": 1, "F3": 2, "F4": 2, "F5": 1, "F6": 1}  # F3 has its language twice
    assert count(master(twice))["F5"] == 2  # the whole master shows a value that comes twice as often


def test_ignored_item_at_a_shown_place(t):
    """An item that the all-blank test ignores is still shown where it is a question."""
    kw = dict(outside=["OUT"], dropped=["DROP"], ignored="Q1")
    a, b = (sorted(map(str, FS.master(t, "STF", "TF", ATTRIBUTES, **kw, one_row=o).collect())) for o in (True, False))
    assert a == b and any("attribute_id='Q1'" in r for r in a)


def test_hot_instance(spark, t):
    """An instance with very many answers: one row each, and one flag."""
    many = dict(t)
    more = spark.range(30_000).selectExpr("concat('H', id) AS id", "'N1' AS interval_id", "'Q1' AS input_field_id")
    many["form_input_value"] = t["form_input_value"].union(more)
    many["form_input_single_select_value"] = t["form_input_single_select_value"].union(more.selectExpr("id", "'A' AS selected_option_id"))
    rows = master(many).filter("instance_id = 'F1'").groupBy("question", "likert75").count().collect()
    assert sorted((r.question, r.likert75, r["count"]) for r in rows) == [(1, 1, 30_001), (2, 1, 1)]


def test_answers_are_read_once(spark):
    """The flag, the language and the match come from the one exchange of the answers (PL6, AG20)."""
    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    _, m = FQ._master(spark, sf)
    plan = m._jdf.queryExecution().executedPlan().toString()
    # the store builds the answers and their chosen options from lineitem: one scan each
    assert plan.count("lineitem.parquet") == 2
