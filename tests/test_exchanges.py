"""What the native reports exchange: narrow rows, of what they show, by keys that are spread."""

import os
import re

import pytest

from survista.plans import catalog  # noqa: F401  (imports the query modules in order)
from survista.plans import family_queries as FQ
from survista.plans import gifted as GIF
from survista.plans import store_queries as SQ
from survista.plans import native_queries as NQ
from survista.plans import views as V
from survista.plans.compliance import compliance_2b
from survista.sources import native_proxy

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tracked_answers_are_not_exchanged_by_item(spark):
    """A form has few asking items: an exchange by the item put all answers to one in one task (F1, F2)."""
    for rows in (GIF.tracked_long(SQ._tracked(spark, SF), **SQ._HERE), GIF.tracked_wide(SQ._tracked(spark, SF), **SQ._HERE)):
        assert not re.search(r"SortMergeJoin \[v_input_field_id#\d+\]", plan_of(rows))


def test_checklist_reads_answers_of_the_instances_shown(spark):
    """After the answers meet the instances only their options and the user's grants are looked up (F3, F7, F8)."""
    plan = plan_of(NQ._checklist(spark, SF, native_proxy.CHECKLIST)[0])
    above = set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan[:re.search(r"SortMergeJoin \[fii_id#\d+\], \[v_interval_id#", plan).start()]))
    assert above == {"v_id", "ss_selected_option_id", "org_unit_id"}


def test_notes_come_from_one_read_of_the_answers(spark):
    """Answers, their chosen options and the options: a scan each, where statements and notes had their own (F3)."""
    assert plan_of(compliance_2b(*NQ._checklist(spark, SF, native_proxy.CHECKLIST))).count("lineitem.parquet") == 3


def test_note_pairs(spark):
    """Every note answer of the section pairs, also a blank one; without a section nothing does."""
    attrs = spark.createDataFrame([("S", "Sec", 1, "a", 1, 0), ("S", "Sec", 1, "n", 2, 1), (None, "None", 2, "b", 3, 0), (None, "None", 2, "m", 4, 1)],
                                  "section_id string, section string, section_sequence int, attribute_id string, sequence int, is_note int")
    detail = spark.createDataFrame([("i", "a", "x"), ("i", "a", "y"), ("i", "n", None), ("i", "n", "note"), ("j", "a", "z"), ("i", "b", "x"), ("i", "m", "x")],
                                   "instance_id string, attribute_id string, value string")
    got = {(r.instance_id, r.value, r.note) for r in compliance_2b(detail, attrs).collect()}
    assert got == {("i", v, n) for v in "xy" for n in (None, "note")}


def test_family_answers_are_those_of_live_submissions(spark):
    """Answers of other instances go before the exchanges by value and by instance (F6, F9-F14)."""
    plan = plan_of(FQ._master(spark, SF, FQ.USER, "RY1997")[1])
    assert re.search(r"Join \[instance_id#\d+\], \[instance_id#\d+\], LeftSemi", plan)


def test_family_answers_are_exchanged_once_with_value_ids(spark):
    """Answers and chosen options are dealt by value id as keys, before their rows are built; those without their value ids go on
    to the exchanges by interval and instance (F10-F13)."""
    plan = plan_of(FQ._master(spark, SF, FQ.USER)[1])
    assert not re.search(r"Exchange hashpartitioning\((v_id|ss_id|v_input_field_id)#", plan)
    assert not re.search(r"Exchange hashpartitioning\(id#\d+, interval_id#", plan)
    assert re.search(r"Exchange hashpartitioning\(v_interval_id#", plan).start() < plan.index("SortMergeJoin [v_id#")  # the last step comes first


def test_family_answers_dealt_by_id_are_the_sql_rows(spark):
    """Rows that come twice and NULL keys: the dealt answers are those of the table's SQL."""
    t = {"lineitem": spark.createDataFrame([(1, 10, 7, 1, 11.0, "A"), (1, 10, 7, 1, 21.0, "R"), (1, None, 7, 1, 11.0, "A"), (1, None, 8, 1, 31.0, "A"), (1, 10, 7, None, 11.0, "A"),
                                            (None, 10, 7, 2, 11.0, "A"), (2, 10, 7, 2, None, "A"), (2, 10, 7, 3, 51.0, "N"), (2, 10, 7, 4, 95.0, None)],
                                           "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string"),
         "orders": spark.createDataFrame([(1, 1), (1, 1), (2, 2), (None, 3), (3, None)], "o_orderkey long, o_custkey long")}
    for name in native_proxy._FAMILY_ANSWERS:
        got = native_proxy._dealt(spark, t, native_proxy._FAMILY_ANSWERS[name])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, spark.sql(native_proxy.FAMILY[name], **t).collect()), key=str)


def test_family_9_reads_its_years_alone(spark):
    """The window of years decides which submissions the master reads, not only which rows are shown (F11)."""
    plan = plan_of(FQ.QUERIES["family_9_native"](spark, SF))
    answers = plan[plan.index("SortMergeJoin [v_interval_id#"):]
    assert re.search(r"Join \[roster_year_id#\d+\], \[__year#\d+\], LeftSemi", answers)


def test_family_reports_exchange_answers_without_value_ids(spark):
    """Reports: no value ids and no answers to dropped items are exchanged, and answers are dealt by instance as ids (F11, F12)."""
    plan = plan_of(FQ._master(spark, SF, FQ.USER)[1])
    assert "value_id" not in plan
    assert plan.count("Exchange hashpartitioning(concat(VD, ") == 1  # the chosen options do not say their item
    assert re.search(r"Exchange hashpartitioning\(instance_id#\d+, \d+\), REPARTITION_BY_COL", plan)


def test_family_records_are_not_exchanged_by_submission(spark):
    """A few submissions, with their years, have all records: they are broadcast to them (F11, F12)."""
    plan = plan_of(FQ._master(spark, SF, FQ.USER)[1])
    assert not re.search(r"Exchange hashpartitioning\((sr_submissions_id|rf_submission_record_id|sel_id)#", plan)


def test_family_attributes_come_from_one_read_of_the_records(spark):
    """The rows of the table's SQL, also of NULLs and of rows that come twice, from one scan of the orders (F12)."""
    t = {"region": spark.createDataFrame([(0, "R0"), (None, "R1")], "r_regionkey int, r_name string"),
         "nation": spark.createDataFrame([(0, "N0", 0), (1, None, 0), (2, "N2", None)], "n_nationkey int, n_name string, n_regionkey int"),
         "customer": spark.createDataFrame([(c, c % 3, "S" if c % 2 else None) for c in (11, 17, 18, 35, 35)] + [(None, 0, "S")], "c_custkey long, c_nationkey int, c_mktsegment string"),
         "orders": spark.createDataFrame([(1, 11), (1, 11), (2, 17), (3, 18), (None, 18), (4, 35), (5, None), (6, 99)], "o_orderkey long, o_custkey long")}
    name = "mon_record_attribute_value"
    got, sql = spark.sql(native_proxy._FAMILY_ATTRIBUTE_ROWS, **t), spark.sql(native_proxy.FAMILY[name], **t)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, sql.collect()), key=str)
    assert plan_of(FQ._store(spark, SF)[name]).count("orders.parquet") == 1


def test_family_keys_dealt_by_id_are_the_sql_rows(spark):
    """Rows that come twice and NULL keys: the dealt tables are those of their SQL (F11, F12)."""
    orders = spark.sql("SELECT * FROM VALUES (1L, 'P', DATE'1995-01-01'), (1L, 'P', DATE'1995-01-01'), (2L, 'O', DATE'1996-01-01'), (NULL, 'P', NULL), (3L, NULL, DATE'1996-01-01') "
                       "AS t(o_orderkey, o_orderstatus, o_orderdate)")
    for name, key in native_proxy._FAMILY_DEALT.items():
        got = native_proxy._dealt(spark, {"orders": orders}, [("orders", key, native_proxy.FAMILY[name])])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, spark.sql(native_proxy.FAMILY[name], orders=orders).collect()), key=str)


def test_kept_options_are_read_from_their_files(spark, tmp_path):
    """Kept views: the options' size is known, and tables are written by zstd (F4, F5)."""
    kept = V.persist_views(NQ._store(spark, SF), str(tmp_path), "test_exchanges_", buckets=2)
    assert "lineitem.parquet" not in plan_of(kept["form_template_input_select_field_option"])
    parts = [*tmp_path.glob("*typed_answers/part-*")]
    assert parts and all(f.name.endswith(".zstd.parquet") for f in parts)
