"""Sources / sinks and filter helpers."""

import glob

from pyspark.sql import functions as F

from survista.operators import branch_if, keep_levels, optional_filter, rollup_by
from survista.sources import code_table, register_views, write_csv


def test_write_csv_one_line_per_record(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\r\nb;<p>c</p>")], "id int, txt string")
    out = str(tmp_path / "x")
    write_csv(df, out, clean_columns=["txt"])
    files = [open(f).read().splitlines() for f in glob.glob(out + "/*.csv")]
    assert all(f[0] == "id,txt" for f in files)  # Spark writes the header in every part file
    assert [line for f in files for line in f[1:]] == ["1,abc"]


def test_register_views_and_code_table(spark):
    t = {"codes": code_table(spark, [("1", "one")], "code string, name string")}
    register_views(spark, t, {"named": lambda tt: tt["codes"].withColumn("n", F.lit(1))})
    assert spark.sql("SELECT name, n FROM named").collect()[0].asDict() == {"name": "one", "n": 1}


def test_branch_if_and_optional_filter(spark):
    df = spark.createDataFrame([("abcdefghijXYZ",), ("other",)], "c string")
    assert optional_filter(df, "c", "All").count() == 2
    assert optional_filter(df, "c", "abcdefghij").count() == 1
    assert branch_if(df, spark.createDataFrame([(True,)], "b boolean")).count() == 2
    assert branch_if(df, False).count() == 0


def test_keep_levels_au_only(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "au string, d string, v int")
    r = rollup_by(df, ["au", "d"], [], [F.sum("v").alias("s")])
    aus = keep_levels(r, "1", ["au_sort_bit", "d_sort_bit"])
    assert sorted((x.au, x.s) for x in aus.collect()) == [("a", 3), ("b", 3)]
