"""Kept views: joins on the bucket key need no exchange, and the layout is walked once."""

import os
import re

import pytest

from survista.operators.eav import attach_typed_values
from survista.plans import catalog  # noqa: F401  (imports the query modules in order)
from survista.plans import native_queries as NQ
from survista.plans import views as V
from survista.sources.tables import persist

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    return V.persist_views(NQ._store(spark, SF), str(tmp_path_factory.mktemp("kept")), "test_kept_", buckets=4)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("Initial Plan")] if "Initial Plan" in text else text


def test_side_tables_join_without_exchange(spark, kept, no_broadcast):
    sides = [kept[f"form_input_{x}_value"] for x in ("text", "single_select")]
    options = spark.createDataFrame([("O1", "one", None, 0)], "id string, label string, report_label string, sequence int")
    typed = attach_typed_values(kept["form_input_value"], *sides, options, kept["form_input_date_value"], kept["form_input_flag_value"])
    plan = plan_of(typed)
    assert plan.count("SortMergeJoin") == 5
    # the one join with an exchange is that of the options
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)", plan)) == {"selected_option_id", "__o"}
    assert typed.count() == kept["form_input_value"].count()


def test_answers_meet_their_instances_without_exchange(kept, no_broadcast):
    d = V.form_instances(kept).join(V.typed_answers(kept), "instance_id")
    plan = plan_of(d)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    per_instance = V.typed_answers(kept).groupBy("instance_id").count()
    assert "Exchange" not in plan_of(per_instance)


def test_same_rows_as_the_views(spark, kept):
    plain = NQ._store(spark, SF)
    for view in (V.formlet_kav, V.formlet_columns):
        a, b = view(kept), view(plain)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def jobs(spark, run):
    """Jobs that ``run`` starts."""
    import uuid

    group, sc = uuid.uuid4().hex, spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc._jsc.clearJobGroup()
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_layout_is_walked_once(kept):
    from survista.plans import compliance as CMP

    attrs = V.compliance_formlet_attributes(kept, "T1")
    out = CMP.compliance_4(V.checklist_detail(kept, "T1"), attrs, section="ARA", borrow_attribute="I4", borrow_section="ARA")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "UnionLoop" not in plan and "CTE" not in plan

def test_export_reads_its_metadata_at_once(spark, kept, tmp_path):
    """The stand-in builds its submissions by joins of its own; here they are a table, as in a real store."""
    t = {**kept, **{n: persist(kept[n], n, str(tmp_path)) for n in ("mon_submissions", "mon_record_set", "mon_record_attribute", "mon_submission_type")}}
    assert jobs(spark, lambda: V.raw_data_by_record_set(t, "U1", "RS0")) <= 6  # a job for each small side, and the read itself
