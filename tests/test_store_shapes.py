"""Operators behind the store queries: dynamic column groups, first-value matrix, gates by name, loading, exporting."""

import pytest
from pyspark.sql import functions as F

from survista.operators.reshape import crosstab_groups, pivot_first
from survista.plans import catalog  # noqa: F401  (imports the query modules in order)
from survista.plans import compliance as CMP
from survista.plans import gifted as GIF
from survista.plans import outcomes as OUT
from survista.schemas import TABLES
from survista.sources.tables import ignore_case, load, write_csv


def test_column_groups_follow_the_data(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", 4), ("b", "y", 5), ("c", None, 7)], "r string, c string, n int")
    run = lambda d: {r.r: [tuple(g) for g in r.groups] for r in crosstab_groups(d, ["r"], "c", {"n": F.sum("n"), "k": F.count("n")}).collect()}
    assert run(df) == {"a": [(None, None, None), ("x", 1, 1), ("y", 2, 1)], "b": [(None, None, None), ("x", None, None), ("y", 9, 2)],
                       "c": [(None, 7, 1), ("x", None, None), ("y", None, None)]}
    more = df.union(spark.createDataFrame([("a", "never seen", 3)], df.schema))
    assert run(more)["b"] == [(None, None, None), ("never seen", None, None), ("x", None, None), ("y", 9, 2)]
    assert run(df.limit(0)) == {}


def test_pivot_takes_the_first_value(spark):
    df = spark.createDataFrame([(1, "p", "late", 2), (1, "p", "early", 1), (1, "q", "only", 9), (2, "q", "x", 1)], "k int, a string, v string, o int")
    got = {r.k: (r.p, r.q) for r in pivot_first(df, ["k"], {a: F.col("a") == a for a in "pq"}, "v", F.col("o")).collect()}
    assert got == {1: ("early", "only"), 2: (None, "x")}


def test_matrix_has_a_row_for_each_instance(spark):
    schema = ("org_unit_id string, submission_mode_id string, record_set_id string, roster_year_id string, submission_sequence int, instance_id string, "
              "attribute_id string, attribute_sequence int, attribute string, value string")
    rows = [("O", "M", "S", "Y", 1, "F1", "A2", 2, "Two", "b"), ("O", "M", "S", "Y", 1, "F1", "A1", 1, "One", "a"), ("O", "M", "S", "Y", 1, "F2", "A1", 1, "One", "c"),
            ("O", "other", "S", "Y", 1, "F3", "A1", 1, "One", "x"), ("O", "M", "other", "Y", 1, "F4", "A1", 1, "One", "x"), ("P", "M", "S", "Y", 1, "F5", "A1", 1, "One", "x"),
            ("O", "M", "S", "Y", 1, "F1", "A3", 1, "One", "0")]
    attributes = spark.createDataFrame([("A1", "One", "S", 1), ("A2", "Two", "S", 2), ("A3", "One", "S", 1), ("A9", "Never", "S", 3)], TABLES["mon_record_attribute"])
    grants = spark.createDataFrame([("U", "O")], TABLES["user_profile_org_unit"])
    got = OUT.record_matrix_by_instance(spark.createDataFrame(rows, schema), attributes, "M", "S", "Y", grants, "U")
    assert got.columns == ["submission_sequence", "instance_id", "One", "Two", "Never"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "F1", "a", "b", None), (1, "F2", "c", None, None)]


def test_borrowed_rows_depend_on_the_section_name(spark):
    detail = spark.createDataFrame([("AU", 1, "Yes", "Met"), ("AU", 9, "No", "Not Met")], "au string, attribute_id int, label string, value string")
    attrs = spark.createDataFrame([(1, "S1", "Goals", 1, 1), (9, "S2", "Other", 2, 1)],
                                  "attribute_id int, section_id string, section string, section_sequence int, sequence int")
    run = lambda name: sorted((r.au, r.position, r.yes, r.no) for r in CMP.compliance_4(
        detail, attrs, section="S1", borrow_attribute=9, when_section=name).collect())
    assert run("Goals") == [(a, p, y, n) for a in ("AU", "State") for p, y, n in ((1.0, 1.0, 0.0), (3.5, 1.0, 1.0), (99.0, 0.0, 1.0))]
    assert run("Another") == [(a, 1.0, 1.0, 0.0) for a in ("AU", "State")]


def test_load_enforces_the_declared_schema(spark, tmp_path):
    def write(name, df):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
    write("org_unit", spark.createDataFrame([("ab-1", "Name", "7", 5)], "ID string, name string, number string, extra int"))
    got = load(spark, str(tmp_path), tables=["org_unit"])["org_unit"]
    assert got.schema == TABLES["org_unit"] and [tuple(r) for r in got.collect()] == [("AB-1", "Name", "7")]
    assert load(spark, str(tmp_path), tables=["org_unit"], upper_ids=False)["org_unit"].first()["id"] == "ab-1"
    write("org_unit", spark.createDataFrame([("1", 7)], "id string, number bigint"))
    with pytest.raises(ValueError, match="name is missing; number is bigint, not string"):
        load(spark, str(tmp_path), tables=["org_unit"])
    write("mon_record_set", spark.createDataFrame([("1", "n", None)], "id string, name string, sampled_from_id string"))
    write("form_template_input_item", spark.createDataFrame([("1", 2)], "id string, report_weight int"))
    with pytest.raises(ValueError, match="input_area_id is missing"):
        load(spark, str(tmp_path), tables=["form_template_input_item"])


def test_csv_cells_stay_on_one_line(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted"\r\nline'), (2, None), (3, "<p>x;</p>")], "k int, v string")
    write_csv(df, str(tmp_path / "out"), clean_columns=["v"])
    back = spark.read.option("header", True).option("escape", '"').schema("k int, v string").csv(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in back.collect()) == [(1, 'a "quoted"line'), (2, None), (3, "x")]


def test_program_modes_are_numbered_by_place(spark):
    def frame(name, rows):
        return spark.createDataFrame([(*r, *[None] * (len(TABLES[name].fields) - len(r))) for r in rows], TABLES[name])
    t = {"mon_location": frame("mon_location", [("L1", "P", "First", 1), ("L2", "P", "Zero", 0), ("L3", "Q", "No", 0)]),
         "mon_submission_type": frame("mon_submission_type", [("T1", "B", "L1", "F"), ("T2", "A", "L1", "F"), ("T3", "Z", "L2", "F"), ("T4", "Z", "L3", "F")]),
         "mon_submission_mode": frame("mon_submission_mode", [("M1", "Annual Budget Review", "T1"), ("M2", "AU Budget: Zero", "T1"), ("M3", "x", "T2"), ("M4", "x", "T3"),
                                                              ("M5", "x", "T4"), ("M6", "out", "T1")])}
    got = sorted((r.mode_sequence, r.submission_mode_id, r.location) for r in GIF.program_modes(t, "P", ["M6"]).collect())
    assert got == [(1, "M4", "Zero"), (2, "M3", "First"), (3, "M1", "First"), (4, "M2", "First")]


def test_text_in_any_case_meets(spark, tmp_path):
    a = ignore_case(spark.createDataFrame([("F", 1), ("f", 2), ("x", 4), (None, 8)], "code string, n int"))
    b = ignore_case(spark.createDataFrame([("f", "Female"), ("X", "Other")], "code string, name string"), ["code"])
    assert sorted((r.code.lower(), r.n) for r in a.filter("code IS NOT NULL").groupBy("code").agg(F.sum("n").alias("n")).collect()) == [("f", 3), ("x", 4)]
    assert sorted((r.name, r.n) for r in a.join(b, "code").collect()) == [("Female", 1), ("Female", 2), ("Other", 4)]
    assert a.filter(F.col("code") == "F").count() == 2 and a.select("code").distinct().count() == 3
    assert b.filter(F.col("name") == "female").count() == 0
    spark.createDataFrame([("u1", "Name", None), ("U2", "NAME", None)], TABLES["org_unit"]).write.parquet(str(tmp_path / "org_unit"))
    assert load(spark, str(tmp_path), tables=["org_unit"], any_case=True)["org_unit"].groupBy("name").count().count() == 1
