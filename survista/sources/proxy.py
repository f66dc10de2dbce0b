"""Stand-in inputs built from the driver's TPC-H-like test tables.

These functions only *shape* rows into the schemas the report jobs expect
(record attributes as EAV rows, answers as formlet rows, an org hierarchy,
a layout tree); they do none of the jobs' work. Mapping:

* State > AU > District > School  =  all > region > nation > market segment
* form instance / record          =  an order
* record attributes (EAV)         =  district, school, priority code, order
                                     status and year of each order
* question                        =  l_linenumber; answer row = lineitem row
* Met / Not Met / Not Applicable  =  l_returnflag A / R / N
* Likert 1-5                      =  ceil(l_quantity / 10), blank when flag N
* language / disability match     =  o_orderstatus / l_linestatus
* roster year                     =  year(o_orderdate)
* user grants                     =  regions granted per user
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import unpivot_facts
from .tables import code_table

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_tables(spark: SparkSession, sf_dir: str, names=NAMES) -> dict[str, DataFrame]:
    """Lazy parquet reads; scans prune columns and push filters per query."""
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


# Fixed values of the stand-in mapping (shared with the DuckDB oracle SQL).
# Code lookups deliberately miss one code each, to exercise NULL vs fallback.
DISABILITY_CODES = [("1", "URG"), ("2", "HIGH"), ("3", "MED"), ("5", "LOW")]
GENDER_CODES = [("F", "Female"), ("O", "Other")]
# Report weight per question (l_linenumber); question 7 is unscored.
QUESTION_WEIGHTS = [(1, 1.0), (2, 1.5), (3, 2.0), (4, 1.0), (5, 0.5), (6, 3.0), (7, None)]
# User grants: U0 sees every region, U1 regions 0-3, U2 region 4.
GRANTS = [("U0", 0), ("U0", 1), ("U0", 2), ("U0", 3), ("U0", 4),
          ("U1", 0), ("U1", 1), ("U1", 2), ("U1", 3), ("U2", 4)]
RECORD_ATTRIBUTES = [("DISTRICT", "District", 1), ("SCHOOL", "School", 2), ("DISABILITY", "Disability", 3),
                     ("GENDER", "Gender", 4), ("YEAR", "Year", 5)]


def instances(t: dict[str, DataFrame]) -> DataFrame:
    """One row per order with its place in the org hierarchy."""
    o, c, n, r = t["orders"], t["customer"], t["nation"], t["region"]
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("o_orderkey").alias("instance_id"),
                    F.col("r_regionkey").alias("org_unit_id"),
                    F.col("r_name").alias("au"),
                    F.col("n_name").alias("district"),
                    F.col("c_mktsegment").alias("school"),
                    F.col("o_orderpriority").alias("priority"),
                    F.col("o_orderstatus").alias("language"),
                    F.year("o_orderdate").alias("roster_year"),
                    F.col("o_orderdate").alias("order_date")))


def record_kav(t: dict[str, DataFrame]) -> DataFrame:
    """Record attributes as long EAV rows: (instance_id, org_unit_id, au,
    roster_year, attribute_id, value)."""
    inst = instances(t)
    spec = {"DISTRICT": F.col("district"), "SCHOOL": F.col("school"),
            "DISABILITY": F.substring("priority", 1, 1), "GENDER": F.col("language"),
            "YEAR": F.col("roster_year").cast("string")}
    return unpivot_facts(inst, ["instance_id", "org_unit_id", "au", "roster_year"], spec,
                         label="attribute_id", value="value")


def answers(t: dict[str, DataFrame]) -> DataFrame:
    """Answer rows (one per lineitem): (instance_id, attribute_id=question,
    value=status label, likert, option_sequence, match)."""
    li = t["lineitem"]
    likert = F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(
        F.ceil(F.col("l_quantity") / 10).cast("int"))
    status = (F.when(F.col("l_returnflag") == "A", "Met").when(F.col("l_returnflag") == "R", "Not Met")
              .otherwise("Not Applicable"))
    return li.select(F.col("l_orderkey").alias("instance_id"), F.col("l_linenumber").alias("attribute_id"),
                     status.alias("value"), likert.alias("likert"), (likert - 1).alias("option_sequence"),
                     F.col("l_linestatus").alias("match"))


def grants(spark: SparkSession) -> DataFrame:
    return code_table(spark, GRANTS, "user_profile_id string, org_unit_id int")


def disability_codes(spark: SparkSession) -> DataFrame:
    return code_table(spark, DISABILITY_CODES, "code string, name string")


def gender_codes(spark: SparkSession) -> DataFrame:
    return code_table(spark, GENDER_CODES, "code string, name string")


def question_weights(spark: SparkSession) -> DataFrame:
    return code_table(spark, QUESTION_WEIGHTS, "question int, report_weight double")


def roster_years(t: dict[str, DataFrame]) -> DataFrame:
    """Roster years (start_year, start_date 1 July, end_date 30 June next
    year) for every order year."""
    y = t["orders"].select(F.year("o_orderdate").alias("start_year")).distinct()
    return y.select("start_year", F.make_date("start_year", F.lit(7), F.lit(1)).alias("start_date"),
                    F.make_date(F.col("start_year") + 1, F.lit(6), F.lit(30)).alias("end_date"))


# Checklist statement metadata for the compliance stand-in: question ->
# section. Fixed values of the stand-in mapping.
STATEMENTS = [(1, "A", "Section A", 1, 1), (2, "A", "Section A", 1, 2), (3, "A", "Section A", 1, 3),
              (4, "B", "Section B", 2, 1), (5, "B", "Section B", 2, 2), (6, "B", "Section B", 2, 3),
              (7, "C", "Section C", 3, 1)]


def statements(spark: SparkSession) -> DataFrame:
    return code_table(spark, STATEMENTS,
                      "attribute_id int, section_id string, section string, section_sequence int, sequence int")


def checklist_detail(t: dict[str, DataFrame]) -> DataFrame:
    """Answer detail rows with the org of their instance:
    (instance_id, au, search_key, attribute_id, value, label)."""
    a = answers(t).withColumn("label", F.when(F.col("value") == "Met", "Yes").when(F.col("value") == "Not Met", "No").otherwise("N/A"))
    inst = instances(t).select("instance_id", "au", "org_unit_id", "roster_year", (F.col("language") == "P").alias("excluded"),
                               F.col("instance_id").cast("string").alias("search_key"))
    return a.join(inst, "instance_id").select("instance_id", "au", "org_unit_id", "roster_year", "excluded", "search_key",
                                              "attribute_id", "value", "label")


def layout_nodes(t: dict[str, DataFrame]) -> DataFrame:
    """Adjacency list: R<regionkey> (root) > N<nationkey> > C<custkey>,
    sequence = key % 50."""
    r = t["region"].select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"),
                           F.lit(None).cast("string").alias("parent_id"),
                           (F.col("r_regionkey") % 50).cast("int").alias("sequence"))
    n = t["nation"].select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")),
                           F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
                           (F.col("n_nationkey") % 50).cast("int"))
    c = t["customer"].select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")),
                             F.concat(F.lit("N"), F.col("c_nationkey").cast("string")),
                             (F.col("c_custkey") % 50).cast("int"))
    return r.unionAll(n).unionAll(c)


# Input item type per question for the typed-answer stand-in (fixed values).
ITEM_TYPES = [(1, "Text"), (2, "Text"), (3, "SingleSelect"), (4, "SingleSelect"), (5, "Date"), (6, "Flag"),
              (7, "MultiSelect")]


def typed_answers(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Answer values split into the typed side tables by the question's
    item type: values (id, interval_id, input_field_id), text / select /
    date / flag side tables keyed by the same id, and select options."""
    li = t["lineitem"]
    vid = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    seq = F.ceil(F.col("l_quantity") / 10).cast("int") - 1
    base = li.select(vid.alias("id"), F.col("l_orderkey").alias("interval_id"),
                     F.col("l_linenumber").alias("input_field_id"), seq.alias("seq"), "l_returnflag",
                     "l_linestatus", "l_shipdate")
    q = F.col("input_field_id")
    return {
        "values": base.select("id", "interval_id", "input_field_id"),
        "text": base.filter(q.isin(1, 2)).select("id", F.concat(F.lit("<p>"), F.col("l_returnflag"), F.lit(";"),
                                                                  F.lit("</p>")).alias("value")),
        "select": base.filter(q.isin(3, 4)).select("id", F.concat(F.lit("O"), F.col("seq").cast("string"))
                                                   .alias("selected_option_id")),
        "date": base.filter(q == 5).select("id", F.col("l_shipdate").alias("value")),
        "flag": base.filter(q == 6).select("id", (F.col("l_linestatus") == "F").alias("value")),
        "options": base.select("seq").distinct().select(
            F.concat(F.lit("O"), F.col("seq").cast("string")).alias("id"),
            F.concat(F.lit("Option "), F.col("seq").cast("string")).alias("label"),
            F.when(F.col("seq") < 2, F.lit("Low")).alias("report_label"), F.col("seq").alias("sequence")),
    }


def item_types(spark: SparkSession) -> DataFrame:
    return code_table(spark, ITEM_TYPES, "input_field_id int, item_type string")


def record_attributes(spark: SparkSession) -> DataFrame:
    return code_table(spark, RECORD_ATTRIBUTES, "attribute_id string, attribute string, attribute_sequence int")
