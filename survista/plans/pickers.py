"""Parameter pickers (PQ1-PQ8): the short choice lists that feed the reports, from the native tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import roster_year_label
from ..operators.filters import active, keep_in, left_join_active
from ..operators.joins import having_rows
from ..operators.measures import dedupe
from ..operators.ranking import first_row, roster_years
from ..sources.tables import code_table
from . import views as V


def _named(df: DataFrame, prefix: str, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def raw_data_parameters(t: dict[str, DataFrame]) -> DataFrame:
    """What the raw-data pickers choose from: program, location, type, mode, year and record set of submissions whose
    record set is sampled from one with attributes (JN16). Submissions that are not live lose their record set in the
    join and with it their row (FI4)."""
    subs = t["mon_submissions"]
    live = subs["deleted_date"].isNull() & subs["reliability_check_of_submissions_id"].isNull()
    child = _named(t["mon_record_set"], "child_", "id", "sampled_from_id")
    d = left_join_active(subs, child, F.col("child_id") == subs["record_set_id"], live)
    parent = _named(t["mon_record_set"], "parent_", "id", "name")
    d = d.join(parent, F.col("parent_id") == F.col("child_sampled_from_id"), "left")
    with_attributes = t["mon_record_attribute"].select(F.col("record_set_id").alias("parent_id"))
    d = having_rows(d, with_attributes, ["parent_id"])
    d = (d.join(_named(t["mon_submission_type"], "st_", "id", "name", "location_id"), F.col("st_id") == F.col("submission_type_id"), "left")
         .join(_named(t["mon_submission_mode"], "m_", "id", "name"), F.col("m_id") == F.col("submission_mode_id"), "left")
         .join(_named(t["mon_location"], "l_", "id", "program_id", "display_name"), F.col("l_id") == F.col("st_location_id"), "left")
         .join(_named(t["mon_program"], "p_", "id", "display_name"), F.col("p_id") == F.col("l_program_id"), "left")
         .join(_named(t["roster_year"], "ry_", "id", "start_year"), F.col("ry_id") == F.col("roster_year_id"), "left"))
    return dedupe(d.select(
        F.col("p_display_name").alias("program"), F.col("l_display_name").alias("location"), F.col("st_name").alias("submission_type"),
        F.col("m_name").alias("submission_mode"), roster_year_label("ry_start_year", "-").alias("roster_year"),
        F.col("parent_id").alias("record_set_id"), F.col("parent_name").alias("record_set"), F.col("p_id").alias("program_id"),
        F.col("l_id").alias("location_id"), F.col("m_id").alias("submission_mode_id"), F.col("ry_id").alias("roster_year_id")))


def raw_data_choices(t: dict[str, DataFrame], choice: str, **chosen) -> DataFrame:
    """PQ1: id and name of the programs, locations, submission modes, roster years or record sets (``choice``: the name without
    ``_id``) left after the choices made so far, given by id (``program_id=...``)."""
    d = raw_data_parameters(t)
    for column, value in chosen.items():
        d = d.filter(F.col(column) == F.lit(value))
    return d.select(F.col(f"{choice}_id").alias("id"), F.col(choice).alias("name")).distinct()


def outcome_record_sets(t: dict[str, DataFrame], submission_mode_id: str) -> DataFrame:
    """PQ6: record sets whose attributes the submissions of a mode have."""
    return (V.record_kav(t).filter(F.col("submission_mode_id") == F.lit(submission_mode_id))
            .select(F.col("record_set_id").alias("id"), F.col("record_set").alias("name")).distinct())


def raw_data(t: dict[str, DataFrame], choice: str, **chosen) -> DataFrame:
    """PQ1: the values of ``choice`` left after the choices made so far (a value or a list for each)."""
    d = raw_data_parameters(t)
    for column, value in chosen.items():
        d = keep_in(d, column, value if isinstance(value, (list, tuple)) else [value])
    return d.select(choice).distinct()


def record_sets(t: dict[str, DataFrame], program: str = "Special Education") -> DataFrame:
    """PQ2: record sets as 'location > mode > set'."""
    d = raw_data_parameters(t).filter(F.col("program") == program)
    label = F.concat("location", F.lit(" > "), "submission_mode", F.lit(" > "), "record_set")
    return d.select(F.col("record_set_id").alias("id"), label.alias("name")).distinct()


def years(t: dict[str, DataFrame], submission_type_id: str) -> DataFrame:
    """PQ3: roster years with submissions of a type."""
    subs = t["mon_submissions"].filter(F.col("submission_type_id") == F.lit(submission_type_id)).select("roster_year_id")
    y = t["roster_year"]
    return y.join(subs, y.id == subs.roster_year_id).select("id", roster_year_label("start_year", "-").alias("name")).distinct()


def modes(t: dict[str, DataFrame], submission_type_id: str, roster_year_id: str) -> DataFrame:
    """PQ4: modes of a type's submissions in a year."""
    subs = t["mon_submissions"].filter((F.col("submission_type_id") == F.lit(submission_type_id)) & (F.col("roster_year_id") == F.lit(roster_year_id)))
    m = _named(t["mon_submission_mode"], "", "id", "name")
    return subs.select("submission_mode_id").join(m, F.col("submission_mode_id") == m.id).select("id", "name").distinct()


def sections(t: dict[str, DataFrame], template_id: str | None, attribute_ids=None) -> DataFrame:
    """PQ5: sections of a checklist, of given statements or of all."""
    d = V.compliance_formlet_attributes(t, template_id)
    if attribute_ids is not None:
        d = keep_in(d, "attribute_id", attribute_ids)
    return d.select("section_id", "section", "section_sequence").distinct()


def questions(t: dict[str, DataFrame], attribute_ids) -> DataFrame:
    """PQ6: given questions of the forms, as code and label."""
    d = keep_in(V.formlet_columns(t), "attribute_id", attribute_ids)
    return d.select("attribute_id", F.concat("attribute_code", F.lit(" "), "attribute_label").alias("name")).distinct()


def default_year(t: dict[str, DataFrame]) -> DataFrame:
    """PQ7: the earliest roster year (SO3)."""
    return first_row(t["roster_year"].select("id", "start_year"), [F.col("start_year").asc(), F.col("id").asc()])


def last_years(t: dict[str, DataFrame], n: int = 3) -> DataFrame:
    """PQ7: the last n roster years."""
    return roster_years(t["roster_year"], n=n, which="latest")


def values_of(master: DataFrame, column: str) -> DataFrame:
    """PQ7: languages or disability matches that occur in the family master."""
    return master.select(F.col(column).alias("value")).distinct()


# The choices of the family reports' two filters.
FAMILY_CHOICES = {"language": ["All", "English", "Spanish", "Blank"], "match": ["All", "Yes", "No", "Blank"]}


def family_years(master: DataFrame, n: int = 3) -> DataFrame:
    """PQ7: the first n roster years of the family master, by name."""
    return master.select(F.col("roster_year_id").alias("id"), F.col("roster_year").alias("name")).distinct().orderBy("name", "id").limit(n)


def family_choices(spark: SparkSession, master: DataFrame) -> DataFrame:
    """PQ7: the fixed lists of the two filters, with the instances that each choice leaves. An instance is counted once for
    each value it has, so the join only sees grouped rows."""
    choices = code_table(spark, [(p, c) for p, cs in FAMILY_CHOICES.items() for c in cs], "parameter string, id string")
    values = F.explode(F.array(*[F.struct(F.lit(p).alias("parameter"), F.left(F.col(c), F.lit(10)).alias("id"))
                                 for p, c in (("language", "language"), ("match", "disability_match"))]))
    one = master.select("instance_id", values.alias("v")).select("instance_id", "v.*")
    every = one.withColumn("id", F.explode(F.array(F.lit("All"), "id")))
    found = every.groupBy("parameter", "id").agg(F.count_distinct("instance_id").alias("instances"))
    return choices.join(found, ["parameter", "id"], "left").select(
        "parameter", "id", F.col("id").alias("name"), F.coalesce("instances", F.lit(0)).alias("instances"))


def form_stats(t: dict[str, DataFrame]) -> DataFrame:
    """PQ8: attributes and modes of each template."""
    return V.formlet_columns(t).groupBy("template_id", "template_name").agg(
        F.count_distinct("attribute_id").alias("attributes"), F.count_distinct("submission_mode").alias("modes"))


def live_submissions(t: dict[str, DataFrame]) -> DataFrame:
    """Live submissions by organisation and year (FI3)."""
    return active(t["mon_submissions"]).groupBy("org_unit_id", "roster_year_id").agg(F.count(F.lit(1)).alias("n"))
