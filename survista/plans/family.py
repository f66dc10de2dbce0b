"""Family-survey views and reports (PL6 shape, RP14-RP19).

``family_master`` builds one row per (instance, question) with the org
hierarchy, Likert and weighted scores and the per-instance Likert75 flag;
the reports filter it (grants, language, disability match), roll it up the
hierarchy and pivot or rank the question measures. Each report aggregates to
(group x question) first, so windows and pivots only see reduced rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (div_floor, likert, merge_buckets, money_text, pad_left, ratio_half_up, round_dec,
                         safe_div, weighted)
from ..operators.filters import optional_filter, restrict_to_user, years_in_window
from ..operators.hierarchy import rollup_by, rollup_regroup
from ..operators.measures import count_where, pct_gt_all, threshold_flag
from ..operators.ranking import top_bottom, top_bottom_join

# Subtotal labels of the family reports.
STATE = "STATE"
BLANK = " "


def family_submissions(submissions: DataFrame) -> DataFrame:
    """PL5 (submissions): one row per form instance with its organisation,
    roster year and record attributes; grades 006 and 007 are one grade."""
    grade = [merge_buckets("grade", [["006", "007"]]).alias("grade")] if "grade" in submissions.columns else []
    return submissions.select(*[c for c in submissions.columns if c != "grade"], *grade)


def family_responses(answers: DataFrame, weights: DataFrame) -> DataFrame:
    """PL5 (responses): answers with ``likert_score`` (option sequence + 1, NULL
    for an item without a report weight) and their weight. Instances whose
    answers are all blank are left out, by a window over the one exchange by
    instance."""
    w = weights.select(F.col("question").alias("attribute_id"), F.col("report_weight").alias("response_weight"))
    scored = F.col("response_weight").isNotNull()
    a = answers.join(w, "attribute_id", "left").withColumns({
        "likert_score": F.when(scored, likert("option_sequence")),
        "weighted_score": F.when(scored, weighted("option_sequence", "response_weight"))})
    a = a.withColumn("__some", F.count("option_sequence").over(Window.partitionBy("instance_id")))
    return a.filter(F.col("__some") > 0).select(
        "instance_id", F.col("attribute_id").alias("question"), "option_sequence", F.col("match").alias("disability_match"), "response_weight",
        "likert_score", "weighted_score")


def family_master(instances: DataFrame, answers: DataFrame, weights: DataFrame, likert75_min: int = 12) -> DataFrame:
    """PL6: submissions left-joined to their responses, with ``likert_gt3`` and
    ``likert75`` = 1 on every row of an instance having at least
    ``likert75_min`` answers above 3 (AG20). A submission without responses
    stays, as one row without a question. The answers are read once."""
    m = family_submissions(instances).join(family_responses(answers, weights), "instance_id", "left")
    m = m.withColumns({"disability_match": F.coalesce("disability_match", F.lit("Blank")),
                       "likert_gt3": F.when(F.col("likert_score") > 3, 1).otherwise(0)})
    return threshold_flag(m, "instance_id", F.col("likert_score") > 3, likert75_min, "likert75")


def _filters(master: DataFrame, grants: DataFrame | None, user_id: str | None, language: str,
             match: str, roster_year=None) -> DataFrame:
    m = master
    if grants is not None and user_id is not None:
        m = restrict_to_user(m, grants, user_id)
    m = optional_filter(optional_filter(m, "language", language), "disability_match", match)
    if roster_year is not None:
        m = m.filter(F.col("roster_year") == F.lit(roster_year))
    return m


_H = ["au", "district", "school"]
_LABELS = {"au": STATE, "district": BLANK, "school": BLANK}
_BITS = {"au": "sort_bit", "district": "district_bit", "school": "school_bit"}


def _qname(q) -> str:
    return f"q{q}"


def family_2(master: DataFrame, questions: Sequence[int], grants=None, user_id=None, language="All",
             match="All", au_only: bool = False) -> DataFrame:
    """RP14: mean Likert per AU / District / School rollup x question, plus
    'Total' = the mean of the question means; cells as 2-decimal text."""
    m = _filters(master, grants, user_id, language, match)
    fine = m.groupBy(*_H, "question").agg(F.sum("likert_score").alias("s"), F.count("likert_score").alias("c"))
    x = rollup_by(fine, _H, ["question"], [F.sum("s").cast("long").alias("s"), F.sum("c").alias("c")], bits=_BITS)
    x = x.withColumn("mean", safe_div("s", "c"))
    if au_only:
        x = x.filter((F.col("district_bit") == 1) & (F.col("school_bit") == 1))
    keys = _H + list(_BITS.values())
    # Cells and total come from one aggregate over the rolled-up rows.
    cell = money_text(ratio_half_up("s", "c", scale=2))
    cells = [F.max(F.when(F.col("question") == F.lit(q), cell)).alias(_qname(q)) for q in questions]
    out = x.groupBy(*keys).agg(*cells, money_text(round_dec(F.avg("mean"), 2)).alias("total"))
    lab = [F.when(F.col(_BITS[h]) == 0, F.col(h)).otherwise(F.lit(_LABELS[h])).alias(n)
           for h, n in zip(_H, ["admin_unit", "district", "school"])]
    return out.select(*lab, *[_qname(q) for q in questions], "total", *_BITS.values())


def family_3(master: DataFrame, questions: Sequence[int], grants=None, user_id=None, language="All",
             match="All", au_only: bool = False) -> DataFrame:
    """RP15: percent of answered questions with Likert > 3 (blanks left out),
    truncated to an int and shown as 'NN%', pivoted by question."""
    m = _filters(master, grants, user_id, language, match)
    fine = m.groupBy(*_H, "question").agg(count_where(F.col("likert_score") > 3).alias("n_gt3"),
                                          F.count("likert_score").alias("n"))
    x = rollup_by(fine, _H, ["question"], [F.sum("n_gt3").alias("n_gt3"), F.sum("n").alias("n")], bits=_BITS)
    if au_only:
        x = x.filter((F.col("district_bit") == 1) & (F.col("school_bit") == 1))
    keys = _H + list(_BITS.values())
    # truncated int percent of the exact ratio (n_gt3 * 100 div n); NULL if n = 0
    x = x.withColumn("cell", F.concat(F.when(F.col("n") > 0, div_floor(F.col("n_gt3") * 100, "n"))
                                      .cast("string"), F.lit("%")))
    wide = x.groupBy(*keys).pivot("question", list(questions)).agg(F.max("cell"))
    for q in questions:
        wide = wide.withColumnRenamed(str(q), _qname(q))
    lab = [F.when(F.col(_BITS[h]) == 0, F.col(h)).otherwise(F.lit(_LABELS[h])).alias(n)
           for h, n in zip(_H, ["admin_unit", "district", "school"])]
    return wide.select(*lab, *[_qname(q) for q in questions], *_BITS.values())


def family_6(master: DataFrame, grants=None, user_id=None, language="All", match="All",
             roster_year=None, question_text: str | Column = "Question") -> DataFrame:
    """RP16: score, weight and weighted score per AU x question with AU and
    overall totals; per-weight subtotal rows merged (rollup then regroup).
    The question label is ``right(' '+seq, 2) + ' - ' + text``; a string for
    ``question_text`` stands before the number."""
    m = _filters(master, grants, user_id, language, match, roster_year)
    text = question_text if isinstance(question_text, Column) else F.concat(F.lit(question_text), F.col("question").cast("string"))
    m = m.withColumn("question_label", F.concat(pad_left("question", 2), F.lit(" - "), text))
    out = rollup_regroup(m, ["au"], "question_label", "response_weight",
                         {"score": F.sum("likert_score").cast("long"), "weighted_score": F.sum("weighted_score")})
    return out.select(F.col("au").alias("admin_unit"), F.col("question_label").alias("question"),
                      "score", F.col("response_weight").alias("weight"), "weighted_score")


def family_7(master: DataFrame, level: str = "AU", grants=None, user_id=None, language="All",
             match="All", roster_year=None) -> DataFrame:
    """RP17: per question at the chosen level (AU / District / School): mean
    Likert and the share above 3 counting blanks as 0."""
    cols = {"AU": ["au"], "District": ["au", "district"], "School": ["au", "district", "school"]}[level]
    m = _filters(master, grants, user_id, language, match, roster_year)
    return m.groupBy(*cols, "question").agg(
        F.avg(F.col("likert_score").cast("double")).alias("mean_likert"),
        pct_gt_all("likert_score").alias("pct_gt3"))


def _au_question_means(m: DataFrame, by_year: bool) -> DataFrame:
    keys = ["roster_year"] if by_year else []
    if by_year:
        x = m.groupBy("au", *keys, "question").agg(F.sum("likert_score").cast("long").alias("s"),
                                                    F.count("likert_score").alias("c"))
        x = x.withColumn("sort_bit", F.lit(0))
    else:
        fine = m.groupBy("au", "question").agg(F.sum("likert_score").alias("s"), F.count("likert_score").alias("c"))
        x = rollup_by(fine, ["au"], ["question"], [F.sum("s").cast("long").alias("s"), F.sum("c").alias("c")],
                      bits={"au": "sort_bit"})
    x = x.withColumn("admin_unit", F.when(F.col("sort_bit") == 0, F.col("au")).otherwise(F.lit(STATE)))
    return (x.withColumn("likert", safe_div("s", "c"))
            .withColumn("likert_score", ratio_half_up("s", "c", scale=2, precision=19).cast("decimal(19,4)")))


def family_8(master: DataFrame, n: int = 3, grants=None, user_id=None, language="All", match="All",
             roster_year=None) -> DataFrame:
    """RP18: the top-n and bottom-n questions by mean Likert per AU and for
    the State, side by side (rank-aligned). Ties broken by question number."""
    m = _filters(master, grants, user_id, language, match, roster_year)
    x = _au_question_means(m, by_year=False)
    out = top_bottom_join(x.select("admin_unit", "sort_bit", "question", "likert", "likert_score"),
                          ["admin_unit", "sort_bit"], "question", "likert", n, tie=["question"], carry=["likert_score"])
    return out.select("admin_unit", "top_question", F.col("top_likert_score").alias("top_likert"), "bottom_question",
                      F.col("bottom_likert_score").alias("bottom_likert"), "sort_bit", F.col("rank").cast("int").alias("sequence"))


def family_9(master: DataFrame, years: DataFrame, as_of, n: int = 3, grants=None, user_id=None,
             language="All", match="All", year: str = "roster_year", year_key: str = "start_year") -> DataFrame:
    """RP19: top-n / bottom-n questions per AU per roster year, for the
    years in the 3-year window around ``as_of``; NULL means rank last. The
    master's ``year`` is looked up in the ``year_key`` of ``years``."""
    m = _filters(master, grants, user_id, language, match)
    yrs = years_in_window(years, as_of).select(F.col(year_key).alias(year))
    m = m.join(yrs, year, "left_semi")
    x = _au_question_means(m, by_year=True)
    ranked = top_bottom(x.select("admin_unit", "roster_year", "question", "likert", "likert_score", "sort_bit"),
                        ["admin_unit", "roster_year"], "likert", n, tie=["question"], rank="sequence")
    return ranked.select("admin_unit", "roster_year", "question", "position", "likert_score", "sort_bit",
                         F.col("sequence").cast("int").alias("sequence"))


__all__ = ["family_submissions", "family_responses", "family_master", "family_2", "family_3", "family_6", "family_7", "family_8", "family_9",
           "count_where"]
