"""Reports on small hand-computed inputs."""

import pytest

from survista.plans import compliance as CMP
from survista.plans import family as FAM


@pytest.fixture
def checklist(spark):
    attrs = spark.createDataFrame([(1, "A", "Sec A", 1, 1), (2, "A", "Sec A", 1, 2), (3, "B", "Sec B", 2, 1), (4, "B", "Sec B", 2, 2)],
                                  "attribute_id int, section_id string, section string, section_sequence int, sequence int")
    yes, no, na = ("Met", "Yes"), ("Not Met", "No"), ("Not Applicable", "N/A")
    rows = [(10, "X", 1, yes), (10, "X", 2, no), (10, "X", 3, na), (11, "Y", 1, no), (11, "Y", 3, yes), (11, "Y", 4, (None, None))]
    detail = spark.createDataFrame([(i, au, str(i), a, v, lab) for i, au, a, (v, lab) in rows],
                                   "instance_id int, au string, search_key string, attribute_id int, value string, label string")
    return detail, CMP.compliance_attributes(attrs)


def test_report_2b_drops_statements_without_a_note(checklist):
    out = CMP.compliance_2b(*checklist).collect()
    assert sorted((r.instance_id, r.attribute_id, r.value, r.note) for r in out) == [(10, 1, "Met", "Not Met"), (11, 3, "Met", None)]


def test_report_4_positions_and_gate(checklist):
    out = CMP.compliance_4(*checklist, section="A", borrow_attribute=3, borrow_section="A").collect()
    got = {(r.au, r.attribute_id, r.position): (r.yes, r.no, r.na, r.blank, r.yes_rate) for r in out}
    assert {r.section for r in out} == {"Sec A"}
    assert got["State", 1, 1.0] == (1, 1, 0, 0, 0.5)
    assert got["X", 3, 99.0] == (0, 0, 1, 0, 0.0) and got["State", 3, 99.0] == (1, 0, 1, 0, 1.0)
    assert got["State", None, 3.5] == (2, 2, 1, 0, 0.5)
    other = CMP.compliance_4(*checklist, section="B", borrow_attribute=3, borrow_section="A").collect()
    assert all(r.position < 3 for r in other) and {r.section for r in other} == {"Sec B"}


def test_report_8_section_counts_met_only(checklist):
    out = CMP.compliance_8_section(*checklist, [["A"], ["B"]], n=1).collect()
    got = {(r.part, r.position): (r.attribute_id, r.yes_count, r.n_size) for r in out}
    assert got[2, "Top"] == (3, 1, 2) and got[2, "Bottom"] == (4, 0, 2)


def test_family_master_and_rounding(spark):
    inst = spark.createDataFrame([(1, "X"), (2, "X"), (3, "Y")], "instance_id int, au string")
    ans = spark.createDataFrame([(1, 1, 4, "F"), (1, 2, 3, "F"), (1, 3, 4, "F"), (2, 1, None, "F"), (2, 2, None, "F")],
                                "instance_id int, attribute_id int, option_sequence int, match string")
    weights = spark.createDataFrame([(1, 1.5), (2, 2.0), (3, None)], "question int, report_weight double")
    m = FAM.family_master(inst, ans, weights, likert75_min=2)
    got = sorted((r.instance_id, r.question or 0, r.likert_score, r.weighted_score, r.disability_match, r.likert75) for r in m.collect())
    assert got == [(1, 1, 5, 7.5, "F", 1), (1, 2, 4, 8.0, "F", 1), (1, 3, None, None, "F", 1),
                   (2, 0, None, None, "Blank", 0), (3, 0, None, None, "Blank", 0)]
    inst = spark.createDataFrame([(k, "X", "d", "s", "en", 2000) for k in range(3)], "instance_id int, au string, district string, school string, language string, roster_year int")
    ans = spark.createDataFrame([(0, 1, 0, "F"), (1, 1, 0, "F"), (2, 1, 1, "F")], "instance_id int, attribute_id int, option_sequence int, match string")
    top = FAM.family_8(FAM.family_master(inst, ans, weights)).collect()
    assert {(r.admin_unit, str(r.top_likert)) for r in top} == {("X", "1.3300"), ("STATE", "1.3300")}
