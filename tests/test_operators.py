"""Operator tests on small hand-made tables (edge cases of the data model)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from survista import functions as SF
from survista.operators import (decode, densify, drop_all_null, emit_scores, flatten_tree, not_in,
                                pivot_attributes, rollup_by, skeleton, top_bottom, unpivot_facts)
from survista.operators.eav import decode_value
from survista.plans.outcomes import pso_rollup


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_pct_half_up_exact(spark):
    df = spark.createDataFrame([(3, 20), (1, 2), (0, 5), (1, 1), (1, 160), (2, 3), (None, 4), (1, 0)], "k long, n long")
    out = [r[0] for r in df.select(SF.pct_of("k", "n")).collect()]
    assert out == [Decimal("15.00"), Decimal("50.00"), Decimal("0.00"), Decimal("100.00"), Decimal("0.63"),
                   Decimal("66.67"), None, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("<p>a;b</p>\r\nc<span>d</span>&nbsp\n", 5, 2014)], "t string, q int, y int")
    r = df.select(SF.clean_text("t").alias("c"), SF.pad_left("q", 2).alias("p"),
                  SF.roster_year_label("y", " - ").alias("l1"), SF.roster_year_label("y").alias("l2"),
                  SF.left_n(F.lit("abcdefghijkl"), 10).alias("l")).first()
    assert (r.c, r.p, r.l1, r.l2, r.l) == ("abcd", " 5", "2014 - 15", "2014-15", "abcdefghij")


def test_not_in_is_null_aware(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = spark.createDataFrame([(1,)], "k int")
    assert rows(not_in(df, sub, "k"), "k") == [(2,)]
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert not_in(df, with_null, "k").count() == 0
    empty = spark.createDataFrame([], "k int")
    assert not_in(df, empty, "k").count() == 3


def test_drop_all_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, None)], "i int, v int")
    assert rows(drop_all_null(df, "i", "v"), "i") == [(2,), (2,)]


def test_rollup_total_equals_sum_of_leaves(spark):
    df = spark.createDataFrame([("a", "x", "k", 1), ("a", "y", "k", 2), ("b", "x", "k", 4), ("b", None, "k", 8)],
                               "au string, d string, k string, v int")
    out = rollup_by(df, ["au", "d"], ["k"], [F.sum("v").alias("s")], labels={"au": "State Total"})
    total = out.filter(F.col("au_sort_bit") == 1).first()
    assert total.au == "State Total" and total.s == 15
    # a real NULL district is a detail row, not a subtotal
    assert out.filter((F.col("d_sort_bit") == 0) & F.col("d").isNull()).count() == 1


def test_top_bottom_mirror_without_ties(spark):
    df = spark.createDataFrame([("g", q, float(q)) for q in range(1, 7)], "g string, q int, m double")
    out = top_bottom(df, "g", "m", 6, tie=["q"])
    top = {r["rank"]: r.q for r in out.filter("position = 'Top'").collect()}
    bot = {r["rank"]: r.q for r in out.filter("position = 'Bottom'").collect()}
    assert all(top[k] == bot[7 - k] for k in range(1, 7))


def test_top_bottom_nulls_last(spark):
    df = spark.createDataFrame([("g", 1, None), ("g", 2, 1.0), ("g", 3, 2.0)], "g string, q int, m double")
    out = top_bottom(df, "g", "m", 1, tie=["q"])
    assert rows(out, "position", "q") == [("Bottom", 2), ("Top", 3)]


def test_densify_count_is_product(spark):
    orgs = spark.createDataFrame([("A",), ("B",), ("C",)], "org string")
    facts = spark.createDataFrame([("A", 2001, "m1", 5)], "org string, year int, mode string, n int")
    skel = skeleton(orgs, {"year": [2001, 2002], "mode": ["m1", "m2"]})
    out = densify(skel, facts, ["org", "year", "mode"], fill={"n": 0})
    assert out.count() == 3 * 2 * 2
    assert out.agg(F.sum("n")).first()[0] == 5


def test_pivot_unpivot_identity(spark):
    wide = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "id int, x string, y string")
    long = unpivot_facts(wide, ["id"], {"x": F.col("x"), "y": F.col("y")}, label="attribute_id", value="value")
    back = pivot_attributes(long, ["id"], {"x": "x", "y": "y"})
    assert rows(back, "id", "x", "y") == rows(wide, "id", "x", "y")


def test_flatten_tree_paths_and_cycles(spark):
    nodes = spark.createDataFrame(
        [("r", None, 1), ("a", "r", 950), ("b", "r", 2), ("c", "a", 3), ("x", "y", 1), ("y", "x", 1)],
        "id string, parent_id string, sequence int")
    out = flatten_tree(nodes, max_depth=10)
    got = {r.id: (r.level, r.path, list(r.path_key)) for r in out.collect()}
    assert got["c"] == (2, "101_1050_103", [1, 950, 3])
    assert set(got) == {"r", "a", "b", "c"}  # the cycle has no root and is never reached
    ordered = [r.id for r in out.orderBy("path_key").collect()]
    assert ordered == ["r", "b", "a", "c"]  # 950 sorts after 2 by the int key


def test_emit_scores_three_rows_only_when_weighted(spark):
    df = spark.createDataFrame([(1, "Q1", "x", 2, 1.5), (2, "Q2", "y", 1, None)],
                               "i int, attribute_code string, value string, value_sequence int, report_weight double")
    df = (df.withColumn("attribute_report_label", F.lit("r")).withColumn("attribute_label", F.lit("l"))
          .withColumn("input_item_type", F.lit("SingleSelect")).withColumn("display_sequence", F.lit("A1")))
    out = emit_scores(df, value_text=SF.float_text)
    got = rows(out, "i", "attribute_code", "value", "weighted")
    assert got == [(1, "LQ1", "3", False), (1, "Q1", "x", None), (1, "WQ1", "4.5", True), (2, "Q2", "y", None)]


def test_decode_fallback_vs_null(spark):
    df = spark.createDataFrame([("1",), ("9",)], "c string")
    lk = spark.createDataFrame([("1", "one")], "code string, name string")
    assert rows(decode(df, "c", lk, "n", fallback=True), "c", "n") == [("1", "one"), ("9", "9")]
    assert rows(decode(df, "c", lk, "n", fallback=False), "c", "n") == [("1", "one"), ("9", None)]


def test_export_decode_refuses_unknown_type(spark):
    df = spark.createDataFrame([("Weird",)], "t string").select(
        "t", *[F.lit(None).cast("string").alias(c) for c in ("text_value", "option_label", "option_report_label")],
        F.lit(None).cast("timestamp").alias("date_value"), F.lit(None).cast("boolean").alias("flag_value"))
    with pytest.raises(Exception):
        df.select(decode_value("t", "export")).collect()


def test_pso_golden_shape(spark):
    """The 9-row expected shape of the source's pasted result: per disability
    n and percent with two decimals (3 of 20 -> 15.00, 1 of 2 -> 50.00)."""
    kav, ans = [], []
    spec = {"SLD": (20, 3), "PD": (2, 1), "ID": (1, 1), "MD": (5, 0)}
    i = 0
    for dis, (n, met) in spec.items():
        for j in range(n):
            i += 1
            kav += [(i, 1, "AU1", "D", "D1"), (i, 1, "AU1", "S", "S1"), (i, 1, "AU1", "X", dis)]
            ans.append((i, "Q", "Met" if j < met else "Not Met"))
    rk = spark.createDataFrame(kav, "instance_id int, org_unit_id int, au string, attribute_id string, value string")
    an = spark.createDataFrame(ans, "instance_id int, attribute_id string, value string")
    out = pso_rollup(rk, an, "Q", "D", "S", "X", levels=1)
    got = rows(out.filter("au_sort_bit = 0"), "dimension", "n_size", "met_count", "pct")
    assert got == [("ID", 1, 1, Decimal("100.00")), ("MD", 5, 0, Decimal("0.00")),
                   ("PD", 2, 1, Decimal("50.00")), ("SLD", 20, 3, Decimal("15.00"))]


def test_flatten_tree_has_no_row_limit(spark):
    nodes = spark.range(1_100_000).selectExpr("id", "CASE WHEN id > 0 THEN 0L END AS parent_id", "CAST(id % 50 AS INT) AS sequence")
    assert flatten_tree(nodes).count() == 1_100_000


def test_tree_path_joins_levels(spark):
    nodes = spark.createDataFrame([(1, None, 2), (2, 1, 950), (3, 2, 3)], "id int, parent_id int, sequence int")
    assert {r.id: r.path for r in flatten_tree(nodes).collect()} == {1: "102", 2: "102_1050", 3: "102_1050_103"}


def test_safe_names_are_unique():
    from survista.operators.eav import safe_names
    names = safe_names(["Q 1", "Q_1", "Q-1", "Q_1_2", "q 1", None, ""])
    assert len({n.lower() for n in names}) == 7 and names[0] == "Q_1"


def test_not_in_builds_without_a_job(spark):
    from survista.operators import not_in
    df, other = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,)], "k int")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = not_in(df, other, "k")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert [r.k for r in out.collect()] == [2]
