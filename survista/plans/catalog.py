"""Registered queries: each runs one report or operator job of the library on
the stand-in inputs derived from the test tables, paired with an
independent DuckDB SQL text computing the same result (the oracle).

Every query reads whole tables; no query samples, caps or subsets its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import proxy
from . import sqlparts as S
from .outcomes import pso_rollup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _t(spark, sf, *names):
    return proxy.read_tables(spark, sf, names or proxy.NAMES)


ORDER_TABLES = ("orders", "customer", "nation", "region", "lineitem")


# -- RP8: rollup AU > District > School x disability (the flagship) ---------------
def _pso_sql(dim_attr: str, lookup_sql: str, fallback: bool, levels: int, user: str) -> str:
    hier = ["au", "district", "school"][:levels]
    labels = {"au": ("admin_unit", "State Total", "au_sort_bit"),
              "district": ("district", "Admin Unit Total", "district_sort_bit"),
              "school": ("school", "District Total", "school_sort_bit")}
    dim = "coalesce(d.name, r.value)" if fallback else "d.name"
    sel = [f"CASE WHEN grouping(p.{h}) = 0 THEN p.{h} ELSE '{labels[h][1]}' END AS {labels[h][0]}" for h in hier]
    bits = [f"CAST(grouping(p.{h}) AS INTEGER) AS {labels[h][2]}" for h in hier]
    n = "count(DISTINCT p.instance_id)"
    k = "CAST(sum(f.answer) AS BIGINT)"
    return S.with_base(
        f"grants AS (SELECT * FROM {S.GRANTS_SQL})",
        f"lk AS (SELECT * FROM {lookup_sql})",
        f"rk2 AS (SELECT * FROM rk WHERE org_unit_id IN (SELECT org_unit_id FROM grants WHERE user_profile_id = '{user}'))",
        f"""pv AS (SELECT r.instance_id, r.au,
               max(CASE WHEN r.attribute_id = 'DISTRICT' THEN r.value END) AS district,
               max(CASE WHEN r.attribute_id = 'SCHOOL' THEN r.value END) AS school,
               max(CASE WHEN r.attribute_id = '{dim_attr}' THEN {dim} END) AS dimension
             FROM rk2 r LEFT JOIN lk d ON r.value = d.code AND r.attribute_id = '{dim_attr}'
             GROUP BY r.instance_id, r.au)""",
        """fl AS (SELECT instance_id, max(CASE WHEN value = 'Met' THEN 1 ELSE 0 END) AS answer
             FROM ans WHERE attribute_id = 1 GROUP BY instance_id)""",
    ) + f"""
    SELECT {', '.join(sel)}, p.dimension AS dimension, {n} AS n_size, {k} AS met_count,
           {S.pct_of(k, n)} AS pct, {', '.join(bits)}
    FROM pv p LEFT JOIN fl f ON p.instance_id = f.instance_id
    GROUP BY ROLLUP({', '.join('p.' + h for h in hier)}), p.dimension"""


@query("rollup_met_pct", _pso_sql("DISABILITY", S.DISAB_SQL, False, 3, "U0"))
def rollup_met_pct(spark: SparkSession, sf: str) -> DataFrame:
    """RP8: PSO by disability - EAV pivot, no-fallback decode, any-match
    flag, rollup with distinct sample sizes and exact met percent."""
    t = _t(spark, sf, *ORDER_TABLES)
    return pso_rollup(proxy.record_kav(t), proxy.answers(t), question_id=1, district_attr="DISTRICT",
                      school_attr="SCHOOL", dimension_attr="DISABILITY", lookup=proxy.disability_codes(spark),
                      fallback=False, levels=3, grants=proxy.grants(spark), user_id="U0")


# -- family survey (PL6, RP14-RP19) -------------------------------------------------
from . import family as FAM  # noqa: E402

QUESTIONS = [q for q, _ in proxy.QUESTION_WEIGHTS]
N_Q = len(QUESTIONS)
LIKERT75_MIN = -(-3 * N_Q // 4)  # ceil(0.75 * number of questions)


def _master(spark, sf):
    t = _t(spark, sf, *ORDER_TABLES)
    return t, FAM.family_master(proxy.instances(t), proxy.answers(t), proxy.question_weights(spark),
                                likert75_min=LIKERT75_MIN)


_FM = S.with_base(
    f"w AS (SELECT * FROM {S.WEIGHTS_SQL})",
    f"grants AS (SELECT * FROM {S.GRANTS_SQL})",
    """resp AS (SELECT a.instance_id, a.attribute_id AS question, a.option_sequence, a.match, w.report_weight,
                  CASE WHEN w.report_weight IS NOT NULL THEN a.option_sequence + 1 END AS likert_score
           FROM ans a LEFT JOIN w ON a.attribute_id = w.question
           WHERE a.instance_id IN (SELECT instance_id FROM ans GROUP BY instance_id HAVING count(option_sequence) > 0))""",
    """fm0 AS (SELECT i.instance_id, a.question, a.option_sequence, coalesce(a.match, 'Blank') AS disability_match,
               i.org_unit_id, i.au, i.district, i.school, i.priority, i.language, i.roster_year, i.order_date,
               a.report_weight AS response_weight, a.likert_score, a.likert_score * a.report_weight AS weighted_score,
               CASE WHEN a.likert_score > 3 THEN 1 ELSE 0 END AS likert_gt3
        FROM inst i LEFT JOIN resp a ON a.instance_id = i.instance_id)""",
    f"""fm AS (SELECT fm0.*, CAST(CASE WHEN k.n >= {LIKERT75_MIN} THEN 1 ELSE 0 END AS INTEGER) AS likert75
        FROM fm0 LEFT JOIN (SELECT instance_id, count(CASE WHEN likert_score > 3 THEN 1 END) AS n
                            FROM fm0 GROUP BY instance_id) k ON fm0.instance_id = k.instance_id)""",
    "fmu AS (SELECT * FROM fm WHERE org_unit_id IN (SELECT org_unit_id FROM grants WHERE user_profile_id = 'U0'))",
)


@query("threshold_flag", _FM + """
    SELECT instance_id, question, likert_score, response_weight, weighted_score, likert_gt3, likert75 FROM fm""")
def threshold_flag(spark, sf):
    """PL6 + AG20: family master rows with the per-instance Likert75 flag."""
    _, m = _master(spark, sf)
    return m.select("instance_id", "question", "likert_score", "response_weight", "weighted_score",
                    "likert_gt3", "likert75")


def _lab(bits=("sort_bit", "district_bit", "school_bit")):
    return (f"CASE WHEN {bits[0]} = 0 THEN au ELSE 'STATE' END AS admin_unit, "
            f"CASE WHEN {bits[1]} = 0 THEN district ELSE ' ' END AS district, "
            f"CASE WHEN {bits[2]} = 0 THEN school ELSE ' ' END AS school")


_ROLL3 = ("CAST(grouping(au) AS INTEGER) AS sort_bit, CAST(grouping(district) AS INTEGER) AS district_bit, "
          "CAST(grouping(school) AS INTEGER) AS school_bit")


def _money_text(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(19,2)) AS VARCHAR)"


_F2_CELLS = ", ".join(f"max(CASE WHEN qk = '{q}' THEN cell END) AS q{q}" for q in QUESTIONS)
_F3_CELLS = ", ".join(f"max(CASE WHEN question = {q} THEN cell END) AS q{q}" for q in QUESTIONS)


@query("mean_of_means_pivot", _FM + f""",
    x AS (SELECT au, district, school, question, CAST(sum(likert_score) AS BIGINT) AS s,
                 count(likert_score) AS c, {_ROLL3}
          FROM fmu GROUP BY ROLLUP(au, district, school), question),
    cells AS (SELECT au, district, school, sort_bit, district_bit, school_bit, CAST(question AS VARCHAR) AS qk,
                     {_money_text(S.ratio_half_up('s', 'c'))} AS cell FROM x
              UNION ALL
              SELECT au, district, school, sort_bit, district_bit, school_bit, 'Total',
                     {_money_text("CAST(CAST(avg(s / NULLIF(c, 0)) AS DECIMAL(38,10)) AS DECIMAL(38,2))")}
              FROM x GROUP BY au, district, school, sort_bit, district_bit, school_bit)
    SELECT {_lab()}, {_F2_CELLS}, max(CASE WHEN qk = 'Total' THEN cell END) AS total,
           sort_bit, district_bit, school_bit
    FROM cells GROUP BY au, district, school, sort_bit, district_bit, school_bit""")
def mean_of_means_pivot(spark, sf):
    """RP14 (AG10, AG14, RS4): mean Likert pivot with a mean-of-means Total."""
    t, m = _master(spark, sf)
    return FAM.family_2(m, QUESTIONS, grants=proxy.grants(spark), user_id="U0")


@query("pct_ge4_excl_blank", _FM + f""",
    x AS (SELECT au, district, school, question, count(CASE WHEN likert_score > 3 THEN 1 END) AS n_gt3,
                 count(likert_score) AS n, {_ROLL3}
          FROM fmu GROUP BY ROLLUP(au, district, school), question),
    c AS (SELECT *, CAST(CASE WHEN n > 0 THEN (n_gt3 * 100) // n END AS VARCHAR) || '%' AS cell FROM x)
    SELECT {_lab()}, {_F3_CELLS}, sort_bit, district_bit, school_bit
    FROM c GROUP BY au, district, school, sort_bit, district_bit, school_bit""")
def pct_ge4_excl_blank(spark, sf):
    """RP15 (AG7, RS5, SF9): percent of answered scoring 4+, as 'NN%' text."""
    t, m = _master(spark, sf)
    return FAM.family_3(m, QUESTIONS, grants=proxy.grants(spark), user_id="U0")


@query("rollup_regroup_weights", _FM + """,
    q AS (SELECT *, right(' ' || CAST(question AS VARCHAR), 2) || ' - Question' || CAST(question AS VARCHAR)
                 AS question_label FROM fmu),
    y AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'Total' END AS au,
                 CASE WHEN grouping(question_label) = 0 THEN question_label ELSE 'Total' END AS question_label,
                 CAST(sum(likert_score) AS BIGINT) AS score,
                 CASE WHEN grouping(question_label) = 0 THEN response_weight END AS response_weight,
                 sum(weighted_score) AS weighted_score
          FROM q GROUP BY ROLLUP(au, question_label), response_weight)
    SELECT au AS admin_unit, question_label AS question, CAST(sum(score) AS BIGINT) AS score,
           response_weight AS weight, sum(weighted_score) AS weighted_score
    FROM y GROUP BY au, question_label, response_weight""")
def rollup_regroup_weights(spark, sf):
    """RP16 (AG13, SF3): score / weight / weighted score with merged totals."""
    t, m = _master(spark, sf)
    return FAM.family_6(m, grants=proxy.grants(spark), user_id="U0")


@query("pct_ge4_incl_blank", _FM + """
    SELECT au, district, question, avg(CAST(likert_score AS DOUBLE)) AS mean_likert,
           avg(CAST(CASE WHEN likert_score > 3 THEN 1 ELSE 0 END AS DOUBLE)) AS pct_gt3
    FROM fmu GROUP BY au, district, question""")
def pct_ge4_incl_blank(spark, sf):
    """RP17 (AG8, AG28): mean and share > 3 counting blanks, District level."""
    t, m = _master(spark, sf)
    return FAM.family_7(m, level="District", grants=proxy.grants(spark), user_id="U0")


@query("top_bottom_join", _FM + f""",
    x AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'STATE' END AS admin_unit,
                 CAST(grouping(au) AS INTEGER) AS sort_bit, question,
                 CAST(sum(likert_score) AS BIGINT) AS s, count(likert_score) AS c
          FROM fmu GROUP BY ROLLUP(au), question),
    x2 AS (SELECT *, s / NULLIF(c, 0) AS likert, CAST({S.ratio_half_up('s', 'c', scale=2, precision=19)} AS DECIMAL(19,4)) AS likert_score FROM x),
    t AS (SELECT *, row_number() OVER (PARTITION BY admin_unit, sort_bit ORDER BY likert DESC NULLS LAST, question NULLS FIRST) AS r FROM x2),
    b AS (SELECT *, row_number() OVER (PARTITION BY admin_unit, sort_bit ORDER BY likert ASC NULLS FIRST, question NULLS FIRST) AS r FROM x2)
    SELECT t.admin_unit, t.question AS top_question, t.likert_score AS top_likert,
           b.question AS bottom_question, b.likert_score AS bottom_likert, t.sort_bit, CAST(t.r AS INTEGER) AS sequence
    FROM t JOIN b ON t.admin_unit = b.admin_unit AND t.sort_bit = b.sort_bit AND t.r = b.r
    WHERE t.r <= 3""")
def top_bottom_join(spark, sf):
    """RP18 (WN4, JN9): top 3 / bottom 3 questions per AU and State side by side."""
    t, m = _master(spark, sf)
    return FAM.family_8(m, n=3, grants=proxy.grants(spark), user_id="U0")


AS_OF = "2000-03-15"


@query("top_bottom_yearly", _FM + f""",
    yrs AS (SELECT DISTINCT roster_year AS start_year, make_date(roster_year, 7, 1) AS start_date,
                   make_date(roster_year + 1, 6, 30) AS end_date FROM inst),
    win AS (SELECT start_year FROM yrs WHERE start_year IN (
              SELECT start_year FROM yrs WHERE start_date <= DATE '{AS_OF}'
                 AND DATE '{AS_OF}' <= end_date + INTERVAL 2 YEAR)),
    x AS (SELECT au AS admin_unit, roster_year, question, CAST(sum(likert_score) AS BIGINT) AS s,
                 count(likert_score) AS c
          FROM fmu WHERE roster_year IN (SELECT start_year FROM win) GROUP BY au, roster_year, question),
    x2 AS (SELECT *, s / NULLIF(c, 0) AS likert, CAST({S.ratio_half_up('s', 'c', scale=2, precision=19)} AS DECIMAL(19,4)) AS likert_score FROM x),
    r AS (SELECT *, row_number() OVER (PARTITION BY admin_unit, roster_year
                      ORDER BY CASE WHEN likert IS NOT NULL THEN 0 ELSE 1 END, likert DESC, question NULLS FIRST) AS rt,
                    row_number() OVER (PARTITION BY admin_unit, roster_year
                      ORDER BY CASE WHEN likert IS NOT NULL THEN 0 ELSE 1 END, likert ASC, question NULLS FIRST) AS rb
          FROM x2)
    SELECT admin_unit, roster_year, question, 'Top' AS position, likert_score, 0 AS sort_bit,
           CAST(rt AS INTEGER) AS sequence FROM r WHERE rt <= 3
    UNION ALL
    SELECT admin_unit, roster_year, question, 'Bottom', likert_score, 0, CAST(rb AS INTEGER) FROM r WHERE rb <= 3""")
def top_bottom_yearly(spark, sf):
    """RP19 (FI11, WN4, WN5, ST1): top/bottom 3 per AU per year, 3-year window."""
    t, m = _master(spark, sf)
    return FAM.family_9(m, proxy.roster_years(t), AS_OF, n=3, grants=proxy.grants(spark), user_id="U0")


# -- compliance checklist (PL4, RP1-RP7) ------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from . import compliance as CMP  # noqa: E402
from ..operators import tree as TR  # noqa: E402

_STMT_SQL = S.values(proxy.STATEMENTS, "attribute_id, section_id, section, section_sequence, sequence")
_CK = S.with_base(
    f"st0 AS (SELECT * FROM {_STMT_SQL})",
    """st AS (SELECT *, CAST(CASE WHEN row_number() OVER (PARTITION BY section_id
                 ORDER BY sequence DESC, attribute_id DESC) = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_note FROM st0)""",
    """det AS (SELECT a.instance_id, i.au, CAST(a.instance_id AS VARCHAR) AS search_key, a.attribute_id, a.value,
                      CASE a.value WHEN 'Met' THEN 'Yes' WHEN 'Not Met' THEN 'No' ELSE 'N/A' END AS label
               FROM ans a JOIN inst i ON a.instance_id = i.instance_id)""",
    "d AS (SELECT det.*, st.section_id, st.section, st.section_sequence, st.sequence, st.is_note "
    "FROM det JOIN st ON det.attribute_id = st.attribute_id)",
)


def _ck(spark, sf):
    t = _t(spark, sf, *ORDER_TABLES)
    return proxy.checklist_detail(t), CMP.compliance_attributes(proxy.statements(spark))


@query("note_pairing", _CK + """
    SELECT s.instance_id, s.section, s.sequence, s.attribute_id, s.value, n.value AS note
    FROM d s JOIN d n ON s.instance_id = n.instance_id AND s.section_id = n.section_id
                          AND n.attribute_id IN (SELECT attribute_id FROM st WHERE is_note = 1)
    WHERE s.attribute_id NOT IN (SELECT attribute_id FROM st WHERE is_note = 1)""")
def note_pairing(spark, sf):
    """RP2 (JN8, JN10, JN11, WN2): statements paired with their section's note."""
    detail, attrs = _ck(spark, sf)
    return CMP.compliance_2b(detail, attrs)


@query("section_pct_met", _CK + f"""
    SELECT au, section_sequence, section,
           {S.ratio_half_up("sum(CASE WHEN value = 'Met' THEN 1 END)",
                            "sum(CASE WHEN value IN ('Met', 'Not Met') THEN 1 END)", scale=4, precision=19, times=100)} AS pct
    FROM d GROUP BY au, section_sequence, section""")
def section_pct_met(spark, sf):
    """RP3 (AG5): percent Met per AU x section (NULL when no Met)."""
    detail, attrs = _ck(spark, sf)
    return CMP.compliance_3(detail, attrs)


@query("nonzero_mean", _CK + f""",
    p AS (SELECT au, section,
           {S.ratio_half_up("sum(CASE WHEN value = 'Met' THEN 1 END)",
                            "sum(CASE WHEN value IN ('Met', 'Not Met') THEN 1 END)", scale=4, precision=19, times=100)} AS pct
          FROM d GROUP BY au, section_sequence, section)
    SELECT au, CAST(CAST(avg(CASE WHEN pct <> 0 THEN CAST(pct AS DOUBLE) / 100.0 END) AS DECIMAL(38,10))
                    AS DECIMAL(38,6)) AS overall
    FROM p GROUP BY au""")
def nonzero_mean_q(spark, sf):
    """RP3 report group (AG24): overall mean of non-zero section percents."""
    from ..functions import round_dec
    detail, attrs = _ck(spark, sf)
    o = CMP.compliance_3_overall(CMP.compliance_3(detail, attrs))
    return o.select("au", round_dec("overall", 6).alias("overall"))


QUERIES["nonzero_mean"] = nonzero_mean_q

_C4_SUMS = ("CAST(sum(yes) AS DOUBLE) AS yes, CAST(sum(no) AS DOUBLE) AS no, CAST(sum(na) AS DOUBLE) AS na, "
            "CAST(sum(blank) AS DOUBLE) AS blank, CAST(grouping(au) AS INTEGER) AS sort_bit")


@query("yes_no_na_blank", _CK + f""",
    yn AS (SELECT au, section_id, section, section_sequence, attribute_id, CAST(sequence AS DOUBLE) AS position,
                  CASE WHEN label = 'Yes' THEN 1 ELSE 0 END AS yes, CASE WHEN label = 'No' THEN 1 ELSE 0 END AS no,
                  CASE WHEN value = 'Not Applicable' THEN 1 ELSE 0 END AS na, CASE WHEN label IS NULL THEN 1 ELSE 0 END AS blank
           FROM d),
    b AS (SELECT * FROM yn WHERE section_id = 'A'
          UNION ALL
          SELECT au, 'A', 'Section A', 1, attribute_id, 99.0, yes, no, na, blank FROM yn WHERE attribute_id = 7),
    r AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END AS au, section_sequence, section, attribute_id,
                 position, {_C4_SUMS}
          FROM b GROUP BY ROLLUP(au), section_sequence, section, attribute_id, position
          UNION ALL
          SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END, section_sequence, section,
                 CAST(NULL AS INTEGER), 3.5, {_C4_SUMS}
          FROM b GROUP BY ROLLUP(au), section_sequence, section)
    SELECT *, CASE WHEN yes + no > 0 THEN yes / (yes + no) ELSE 0.0 END AS yes_rate FROM r""")
def yes_no_na_blank(spark, sf):
    """RP4 (ST2, AG4, AG10, SO5, AG25): Yes/No/NA/Blank per statement per AU
    and State of section A, with its Overall row and statement 7 borrowed."""
    detail, attrs = _ck(spark, sf)
    return CMP.compliance_4(detail, attrs, section="A", borrow_attribute=7, borrow_section="A")


@query("item_pct_of_sample", _CK + f""",
    y AS (SELECT *, CASE WHEN value IN ('Met', 'Not Applicable') THEN 1 ELSE 0 END AS yes FROM d),
    ss AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END AS au, CAST(grouping(au) AS INTEGER) AS sort_bit,
                  count(DISTINCT instance_id) AS n_size FROM y GROUP BY ROLLUP(au)),
    ac AS (SELECT CASE WHEN grouping(au) = 0 THEN au ELSE 'State' END AS au, CAST(grouping(au) AS INTEGER) AS sort_bit,
                  section, attribute_id, sequence, CAST(sum(yes) AS BIGINT) AS yes_count
           FROM y GROUP BY ROLLUP(au), section, attribute_id, sequence)
    SELECT ac.au AS admin_unit, section, attribute_id, sequence, yes_count, n_size,
           CAST({S.ratio_half_up('yes_count', 'n_size', scale=2, times=100)} AS DECIMAL(5,1)) AS item_pct, ac.sort_bit
    FROM ac LEFT JOIN ss ON ac.au = ss.au AND ac.sort_bit = ss.sort_bit""")
def item_pct_of_sample(spark, sf):
    """RP5 (AG19): statement yes count over the org's sample size, AU and State."""
    detail, attrs = _ck(spark, sf)
    return CMP.compliance_4_sample(detail, attrs)


@query("top_bottom_global", _CK + f""",
    c AS (SELECT attribute_id, CAST(sum(CASE WHEN label = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS yes_count,
                 CAST(sum(CASE WHEN label = 'Yes' THEN 1 ELSE 0 END) + sum(CASE WHEN label = 'No' THEN 1 ELSE 0 END) AS BIGINT) AS total
          FROM d GROUP BY attribute_id),
    c2 AS (SELECT *, CAST({S.ratio_half_up('yes_count', 'total', scale=2, times=100)} AS DECIMAL(5,1)) AS pct FROM c WHERE total > 0),
    r AS (SELECT *, row_number() OVER (ORDER BY pct DESC, yes_count DESC, attribute_id) AS top_sort,
                    row_number() OVER (ORDER BY pct ASC, yes_count ASC, attribute_id) AS bottom_rank FROM c2)
    SELECT 'Top' AS position, CAST(top_sort AS INTEGER) AS sort, CAST(bottom_rank AS INTEGER) AS bottom_rank, attribute_id, pct
    FROM r WHERE top_sort <= 5
    UNION ALL
    SELECT 'Bottom', CAST(top_sort AS INTEGER), CAST(bottom_rank AS INTEGER), attribute_id, pct FROM r WHERE bottom_rank <= 5""")
def top_bottom_global(spark, sf):
    """RP6 (AG4, WN6, SO2): top/bottom 5 statements overall."""
    detail, _ = _ck(spark, sf)
    return CMP.compliance_8(detail, n=5)


@query("section_top_bottom", _CK + f""",
    y AS (SELECT *, CASE WHEN section_id IN ('A', 'B') THEN 1 WHEN section_id IN ('C') THEN 2 END AS part,
                 CASE WHEN value = 'Met' THEN 1 ELSE 0 END AS yes FROM d),
    y2 AS (SELECT * FROM y WHERE part IS NOT NULL),
    ss AS (SELECT count(DISTINCT instance_id) AS n_size FROM y2),
    ac AS (SELECT part, attribute_id, CAST(sum(yes) AS BIGINT) AS yes_count FROM y2 GROUP BY part, attribute_id),
    p AS (SELECT ac.*, ss.n_size, CAST({S.ratio_half_up('yes_count', 'n_size', scale=2, times=100)} AS DECIMAL(5,1)) AS item_pct
          FROM ac, ss),
    r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY item_pct DESC NULLS LAST, attribute_id) AS rt,
                    row_number() OVER (PARTITION BY part ORDER BY item_pct ASC NULLS LAST, attribute_id) AS rb FROM p)
    SELECT part, 'Top' AS position, CAST(rt AS INTEGER) AS sequence, attribute_id, yes_count, n_size, item_pct FROM r WHERE rt <= 5
    UNION ALL
    SELECT part, 'Bottom', CAST(rb AS INTEGER), attribute_id, yes_count, n_size, item_pct FROM r WHERE rb <= 5""")
def section_top_bottom(spark, sf):
    """RP7 (ST3, AG19, WN4, SO2): State-level top/bottom 5 within section groups."""
    detail, attrs = _ck(spark, sf)
    return CMP.compliance_8_section(detail, attrs, [["A", "B"], ["C"]], n=5)


# -- form layout tree (RS1, JN7, WN1-WN3, PL4) --------------------------------------
_TREE = """WITH RECURSIVE nodes AS (
      SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent_id,
             CAST(r_regionkey % 50 AS INTEGER) AS sequence FROM region
      UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR),
             CAST(n_nationkey % 50 AS INTEGER) FROM nation
      UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR),
             CAST(c_custkey % 50 AS INTEGER) FROM customer),
    walk AS (
      SELECT id, parent_id, sequence, id AS root_id, 0 AS level, CAST(100 + sequence AS VARCHAR) AS path,
             [sequence] AS path_key FROM nodes WHERE parent_id IS NULL
      UNION ALL
      SELECT c.id, c.parent_id, c.sequence, w.root_id, w.level + 1, w.path || '_' || CAST(100 + c.sequence AS VARCHAR),
             list_concat(w.path_key, [c.sequence]) FROM nodes c JOIN walk w ON c.parent_id = w.id)
"""


def _tree(spark, sf):
    t = _t(spark, sf, "region", "nation", "customer")
    return TR.flatten_tree(proxy.layout_nodes(t))


@query("tree_flatten", _TREE + """
    SELECT id, parent_id, sequence, root_id, level, path,
           CAST(row_number() OVER (PARTITION BY root_id ORDER BY path_key, id) AS INTEGER) AS attr_seq FROM walk""")
def tree_flatten(spark, sf):
    """RS1 + WN1: recursive walk with level, '100+seq' path and per-root sequence."""
    w = _tree(spark, sf)
    return TR.sequence(w, "root_id", ["path_key", "id"], "attr_seq").drop("path_key")


@query("last_in_section", _TREE + """,
    st AS (SELECT c.id, c.parent_id AS section_id, p.sequence AS section_sequence, c.sequence, c.root_id, c.path_key
           FROM walk c JOIN walk p ON c.parent_id = p.id WHERE c.level = 2)
    SELECT id, section_id, section_sequence, sequence,
           CAST(row_number() OVER (PARTITION BY root_id ORDER BY path_key, id) AS INTEGER) AS attr_seq,
           CAST(CASE WHEN row_number() OVER (PARTITION BY section_id ORDER BY sequence DESC, id DESC) = 1
                THEN 1 ELSE 0 END AS INTEGER) AS is_note,
           CAST(row_number() OVER (PARTITION BY section_id ORDER BY sequence DESC, id DESC) AS INTEGER) AS reverse_seq
    FROM st""")
def last_in_section(spark, sf):
    """PL4 on the layout tree (JN7, WN1, WN2, WN3): statements with their
    section, sequence per template, last-in-section flag, reverse sequence."""
    w = _tree(spark, sf)
    st = TR.attach_parent(w.filter(F.col("level") == 2), columns=["sequence"], prefix="section_", parents=w)
    st = st.withColumnRenamed("parent_id", "section_id")
    st = TR.sequence(st, "root_id", ["path_key", "id"], "attr_seq")
    st = TR.flag_last(st, "section_id", ["sequence", "id"], "is_note")
    st = TR.sequence(st, "section_id", ["sequence", "id"], "reverse_seq", desc=True)
    return st.select("id", "section_id", "section_sequence", "sequence", "attr_seq", "is_note", "reverse_seq")


# -- EAV decode / pivot / derived rows (PJ3, JN5, RS2, RS3, RS7) -------------------------
from ..functions import float_text  # noqa: E402
from ..operators import eav as EAV  # noqa: E402

_RK_PIVOT = """
    SELECT instance_id, au,
           max(CASE WHEN attribute_id = 'DISTRICT' THEN value END) AS {d},
           max(CASE WHEN attribute_id = 'SCHOOL' THEN value END) AS {s},
           max(CASE WHEN attribute_id = 'DISABILITY' THEN value END) AS {x},
           max(CASE WHEN attribute_id = 'GENDER' THEN value END) AS {g},
           max(CASE WHEN attribute_id = 'YEAR' THEN value END) AS {y}
    FROM rk GROUP BY instance_id, au"""


@query("eav_pivot", S.with_base() + _RK_PIVOT.format(d="district", s="school", x="disability", g="gender", y="year"))
def eav_pivot(spark, sf):
    """RS2: fixed-attribute EAV -> wide pivot (max(case when ...))."""
    t = _t(spark, sf, *ORDER_TABLES)
    return EAV.pivot_attributes(proxy.record_kav(t), ["instance_id", "au"],
                                {"DISTRICT": "district", "SCHOOL": "school", "DISABILITY": "disability",
                                 "GENDER": "gender", "YEAR": "year"})


@query("eav_pivot_dynamic", S.with_base() + _RK_PIVOT.format(d="District", s="School", x="Disability",
                                                             g="Gender", y="Year"))
def eav_pivot_dynamic(spark, sf):
    """RS3: pivot whose columns come from attribute metadata at run time."""
    t = _t(spark, sf, *ORDER_TABLES)
    return EAV.pivot_from_metadata(proxy.record_kav(t), proxy.record_attributes(spark), ["instance_id", "au"])


@query("derived_rows", S.with_base(
    f"w AS (SELECT * FROM {S.WEIGHTS_SQL})",
    """f AS (SELECT a.instance_id, a.attribute_id AS question, 'Q' || CAST(a.attribute_id AS VARCHAR) AS code,
                  a.value, a.option_sequence, w.report_weight FROM ans a LEFT JOIN w ON a.attribute_id = w.question)""") + """
    SELECT instance_id, question, code AS attribute_code, 'Question ' || code AS attribute_report_label,
           'Question ' || code AS attribute_label, 'SingleSelect' AS input_item_type,
           'A' || CAST(question AS VARCHAR) AS display_sequence, value, report_weight, CAST(NULL AS BOOLEAN) AS weighted
    FROM f
    UNION ALL
    SELECT instance_id, question, 'L' || code, 'Likert Score ' || code, 'Likert Score ' || code, 'Derived',
           'BA' || CAST(question AS VARCHAR), CAST(option_sequence + 1 AS VARCHAR), report_weight, false
    FROM f WHERE report_weight IS NOT NULL
    UNION ALL
    SELECT instance_id, question, 'W' || code, 'Weighted Score ' || code, 'Weighted Score ' || code, 'Derived',
           'CA' || CAST(question AS VARCHAR),
           CASE WHEN (option_sequence + 1) * report_weight = floor((option_sequence + 1) * report_weight)
                THEN CAST(CAST(floor((option_sequence + 1) * report_weight) AS BIGINT) AS VARCHAR)
                ELSE CAST((option_sequence + 1) * report_weight AS VARCHAR) END,
           report_weight, true
    FROM f WHERE report_weight IS NOT NULL""")
def derived_rows(spark, sf):
    """RS7 (SF12): each answer as is, plus Likert and weighted rows for scored items."""
    t = _t(spark, sf, "lineitem")
    a = proxy.answers(t).join(proxy.question_weights(spark).withColumnRenamed("question", "attribute_id"),
                              "attribute_id", "left")
    code = F.concat(F.lit("Q"), F.col("attribute_id").cast("string"))
    kav = a.select("instance_id", F.col("attribute_id").alias("question"), code.alias("attribute_code"),
                   F.concat(F.lit("Question "), code).alias("attribute_report_label"),
                   F.concat(F.lit("Question "), code).alias("attribute_label"),
                   F.lit("SingleSelect").alias("input_item_type"),
                   F.concat(F.lit("A"), F.col("attribute_id").cast("string")).alias("display_sequence"),
                   "value", F.col("option_sequence").alias("value_sequence"), "report_weight")
    out = EAV.emit_scores(kav, value_text=float_text)
    return out.drop("value_sequence")


@query("typed_value_decode", """
    WITH b AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
                      l_orderkey AS interval_id, l_linenumber AS input_field_id,
                      CAST(ceil(l_quantity / 10) AS INTEGER) - 1 AS seq, l_returnflag, l_linestatus, l_shipdate
               FROM lineitem),
    tv AS (SELECT id, '<p>' || l_returnflag || ';</p>' AS value FROM b WHERE input_field_id IN (1, 2)),
    sv AS (SELECT id, 'O' || CAST(seq AS VARCHAR) AS selected_option_id FROM b WHERE input_field_id IN (3, 4)),
    dv AS (SELECT id, l_shipdate AS value FROM b WHERE input_field_id = 5),
    fv AS (SELECT id, l_linestatus = 'F' AS value FROM b WHERE input_field_id = 6),
    opt AS (SELECT DISTINCT 'O' || CAST(seq AS VARCHAR) AS id, 'Option ' || CAST(seq AS VARCHAR) AS label,
                   CASE WHEN seq < 2 THEN 'Low' END AS report_label FROM b),
    it AS (SELECT * FROM """ + S.values(proxy.ITEM_TYPES, "input_field_id, item_type") + """),
    v AS (SELECT b.id, b.input_field_id, tv.value AS text_value, opt.label AS option_label,
                 opt.report_label AS option_report_label, dv.value AS date_value, fv.value AS flag_value
          FROM b LEFT JOIN tv ON b.id = tv.id LEFT JOIN sv ON b.id = sv.id
          LEFT JOIN opt ON sv.selected_option_id = opt.id
          LEFT JOIN dv ON b.id = dv.id LEFT JOIN fv ON b.id = fv.id)
    SELECT v.id AS value_id, v.input_field_id, it.item_type,
           CASE it.item_type
             WHEN 'Text' THEN replace(replace(replace(replace(replace(replace(replace(replace(replace(
                    text_value, '<span>', ''), '</span>', ''), '<p>', ''), '</p>', ''),
                    '&nbsp', ''), ';', ''), chr(13) || chr(10), ''), chr(13), ''), chr(10), '')
             WHEN 'SingleSelect' THEN option_label
             WHEN 'Date' THEN strftime(date_value, '%m/%d/%Y')
             WHEN 'Flag' THEN CAST(CAST(flag_value AS INTEGER) AS VARCHAR)
             WHEN 'MultiSelect' THEN 'Multi-select data not pulled' END AS export_value,
           CASE it.item_type
             WHEN 'Text' THEN text_value
             WHEN 'SingleSelect' THEN coalesce(option_report_label, option_label)
             WHEN 'Date' THEN strftime(date_value, '%m/%d/%Y')
             WHEN 'Flag' THEN CAST(CAST(flag_value AS INTEGER) AS VARCHAR) END AS report_value
    FROM v JOIN it ON v.input_field_id = it.input_field_id""")
def typed_value_decode(spark, sf):
    """JN5 + PJ3 + SF6: typed side tables joined back and decoded per item type."""
    t = _t(spark, sf, "lineitem")
    ta = proxy.typed_answers(t)
    v = EAV.attach_typed_values(ta["values"], ta["text"], ta["select"], ta["options"], ta["date"], ta["flag"])
    v = v.join(proxy.item_types(spark), "input_field_id")
    return v.select(F.col("id").alias("value_id"), "input_field_id", "item_type",
                    EAV.decode_value("item_type", "export").alias("export_value"),
                    EAV.decode_value("item_type", "report_label").alias("report_value"))


# -- outcome variants (RP9-RP13, JN6) ---------------------------------------------
from .outcomes import record_matrix  # noqa: E402
from ..operators.joins import decode as _decode  # noqa: E402


@query("rollup_by_dimension", _pso_sql("GENDER", S.GENDER_SQL, True, 2, "U1"))
def rollup_by_dimension(spark, sf):
    """RP12 (AG18, JN6 fallback): rollup AU > District x chosen dimension (gender)."""
    t = _t(spark, sf, *ORDER_TABLES)
    return pso_rollup(proxy.record_kav(t), proxy.answers(t), question_id=1, district_attr="DISTRICT",
                      school_attr="SCHOOL", dimension_attr="GENDER", lookup=proxy.gender_codes(spark),
                      fallback=True, levels=2, grants=proxy.grants(spark), user_id="U1")


def _decode_sql(fallback: bool) -> str:
    name = "coalesce(g.name, r.value)" if fallback else "g.name"
    return S.with_base(f"g AS (SELECT * FROM {S.GENDER_SQL})") + f"""
    SELECT r.instance_id, r.value AS code, {name} AS name
    FROM rk r LEFT JOIN g ON r.value = g.code WHERE r.attribute_id = 'GENDER'"""


def _decode_q(spark, sf, fallback):
    t = _t(spark, sf, *ORDER_TABLES)
    rk = proxy.record_kav(t).filter(F.col("attribute_id") == "GENDER")
    return _decode(rk, "value", proxy.gender_codes(spark), out="name", fallback=fallback).select(
        "instance_id", F.col("value").alias("code"), "name")


@query("decode_with_fallback", _decode_sql(True))
def decode_with_fallback(spark, sf):
    """JN6: code -> name, unknown codes kept."""
    return _decode_q(spark, sf, True)


@query("decode_no_fallback", _decode_sql(False))
def decode_no_fallback(spark, sf):
    """JN6: code -> name, unknown codes become NULL."""
    return _decode_q(spark, sf, False)


@query("record_matrix", S.with_base() + """
    SELECT au, attribute_id, arg_min(value, instance_id) AS first_value, count(*) AS n_records
    FROM rk GROUP BY au, attribute_id""")
def record_matrix_q(spark, sf):
    """RP13 (AG26): first value (by record id) and count per AU x attribute."""
    t = _t(spark, sf, *ORDER_TABLES)
    return record_matrix(proxy.record_kav(t))


QUERIES["record_matrix"] = record_matrix_q


# -- text, years, predicates, pickers (SF*, SO4, FI*, JN10-JN12, WN7, PJ2, PJ4, PQ1) ---------
from ..functions import KEEP, clean_text, map_values, merge_buckets, optional_eq, roster_year_label  # noqa: E402
from ..operators import filters as FI  # noqa: E402
from ..operators import joins as JN  # noqa: E402
from ..operators import ranking as RK  # noqa: E402

_REPL = "html"
for _s in ("<span>", "</span>", "<p>", "</p>", "&nbsp", ";"):
    _REPL = f"replace({_REPL}, '{_s}', '')"
for _s in ("chr(13) || chr(10)", "chr(13)", "chr(10)"):
    _REPL = f"replace({_REPL}, {_s}, '')"


@query("text_clean", f"SELECT page_id, {_REPL} AS text FROM pages")
def text_clean(spark, sf):
    """SF6: whole pages through the fixed nested replaces (export cleaning)."""
    p = _t(spark, sf, "pages")["pages"]
    return p.select("page_id", clean_text("html").alias("text"))


@query("roster_year_label", """
    SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS start_year,
           CAST(year(o_orderdate) AS VARCHAR) || ' - ' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS label_spaced,
           CAST(year(o_orderdate) AS VARCHAR) || '-' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS label
    FROM orders""")
def roster_year_label_q(spark, sf):
    """SF5: the two roster-year label formats."""
    y = proxy.roster_years(_t(spark, sf, "orders"))
    return y.select("start_year", roster_year_label("start_year", " - ").alias("label_spaced"),
                    roster_year_label("start_year", "-").alias("label"))


QUERIES["roster_year_label"] = roster_year_label_q


@query("latest_three_years", """
    WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS start_year FROM orders)
    SELECT 'latest' AS which, start_year FROM (SELECT start_year FROM y ORDER BY start_year DESC LIMIT 3)
    UNION ALL
    SELECT 'earliest', start_year FROM (SELECT start_year FROM y ORDER BY start_year ASC LIMIT 3)""")
def latest_three_years(spark, sf):
    """SO4 (PQ7): the latest three and the literal earliest three roster years."""
    y = proxy.roster_years(_t(spark, sf, "orders"))
    latest = RK.roster_years(y, n=3, which="latest").select(F.lit("latest").alias("which"), "start_year")
    earliest = RK.roster_years(y, n=3, which="earliest").select(F.lit("earliest").alias("which"), "start_year")
    return latest.unionByName(earliest)


@query("year_window", f"""
    WITH yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS start_year FROM orders),
    y AS (SELECT start_year, make_date(start_year, 7, 1) AS start_date, make_date(start_year + 1, 6, 30) AS end_date FROM yrs)
    SELECT * FROM y WHERE start_year IN (SELECT start_year FROM y WHERE start_date <= DATE '{AS_OF}'
                                         AND DATE '{AS_OF}' <= end_date + INTERVAL 2 YEAR)""")
def year_window(spark, sf):
    """FI11: roster years in the 3-year window around the as-of date."""
    return FI.years_in_window(proxy.roster_years(_t(spark, sf, "orders")), AS_OF)


@query("access_semi_join", S.with_base(f"grants AS (SELECT * FROM {S.GRANTS_SQL})") + """
    SELECT instance_id, au FROM inst
    WHERE org_unit_id IN (SELECT org_unit_id FROM grants WHERE user_profile_id = 'U1')""")
def access_semi_join(spark, sf):
    """FI5 (JN10): rows restricted to the orgs granted to a user."""
    t = _t(spark, sf, *ORDER_TABLES)
    return FI.restrict_to_user(proxy.instances(t), proxy.grants(spark), "U1").select("instance_id", "au")


@query("not_in_rows", S.with_base() + """
    SELECT instance_id, attribute_id FROM ans
    WHERE instance_id NOT IN (SELECT instance_id FROM inst WHERE language = 'F')""")
def not_in_rows(spark, sf):
    """JN11: NULL-aware NOT IN (subquery) as a shuffle anti join."""
    t = _t(spark, sf, *ORDER_TABLES)
    done = proxy.instances(t).filter(F.col("language") == "F").select("instance_id")
    return JN.not_in(proxy.answers(t), done, "instance_id").select("instance_id", "attribute_id")


@query("all_null_antijoin", S.with_base() + """
    SELECT instance_id, count(*) AS n_answers, count(likert) AS n_answered FROM ans
    WHERE instance_id NOT IN (SELECT instance_id FROM ans GROUP BY instance_id HAVING count(likert) = 0)
    GROUP BY instance_id""")
def all_null_antijoin(spark, sf):
    """JN12 + AG15: drop instances whose answers are all blank."""
    a = proxy.answers(_t(spark, sf, "lineitem"))
    kept = JN.drop_all_null(a, "instance_id", "likert")
    return kept.groupBy("instance_id").agg(F.count(F.lit(1)).alias("n_answers"), F.count("likert").alias("n_answered"))


@query("optional_filter", _FM + """
    SELECT au, count(*) AS n, CAST(sum(likert_score) AS BIGINT) AS score FROM fm
    WHERE left(language, 10) = 'O' GROUP BY au""")
def optional_filter(spark, sf):
    """FI6: optional ('All' or match) parameter filters on the family master."""
    _, m = _master(spark, sf)
    m = m.filter(optional_eq("language", "O") & optional_eq("disability_match", "All"))
    return m.groupBy("au").agg(F.count(F.lit(1)).alias("n"), F.sum("likert_score").cast("long").alias("score"))


@query("both_ends_pick", _FM + """,
    x AS (SELECT au, question, sum(likert_score) / NULLIF(count(likert_score), 0) AS likert FROM fmu GROUP BY au, question),
    r AS (SELECT *, row_number() OVER (PARTITION BY au ORDER BY likert DESC NULLS LAST, question NULLS FIRST) AS sequence,
                    count(*) OVER (PARTITION BY au) AS cnt FROM x)
    SELECT au, question, likert, CAST(sequence AS INTEGER) AS sequence FROM r
    WHERE sequence <= 2 OR sequence > cnt - 2""")
def both_ends_pick(spark, sf):
    """WN7: the two best and two worst questions per AU (rank <= n or > count - n)."""
    from ..functions import safe_div
    _, m = _master(spark, sf)
    m = FI.restrict_to_user(m, proxy.grants(spark), "U0")
    x = m.groupBy("au", "question").agg(safe_div(F.sum("likert_score"), F.count("likert_score")).alias("likert"))
    return RK.both_ends(x, "au", "likert", 2, tie=["question"]).select(
        "au", "question", "likert", F.col("sequence").cast("int").alias("sequence"))


@query("bucket_merge", S.with_base() + """
    SELECT au, CASE WHEN priority IN ('4-NOT SPECIFIED', '5-LOW') THEN '4-NOT SPECIFIED,5-LOW' ELSE priority END AS bucket,
           CASE WHEN language = 'F' THEN 'Finished' WHEN language = 'O' THEN 'Open' ELSE language END AS status,
           count(*) AS n
    FROM inst GROUP BY 1, 2, 3""")
def bucket_merge(spark, sf):
    """PJ4 + PJ2: merge code buckets and map codes to labels, then count."""
    inst = proxy.instances(_t(spark, sf, *ORDER_TABLES))
    return inst.groupBy("au", merge_buckets("priority", [["4-NOT SPECIFIED", "5-LOW"]]).alias("bucket"),
                        map_values("language", {"F": "Finished", "O": "Open"}, KEEP).alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


from . import native_queries  # noqa: E402

QUERIES.update(native_queries.QUERIES)
ORACLE.update(native_queries.ORACLE)

from . import scoped_queries  # noqa: E402

QUERIES.update(scoped_queries.QUERIES)
ORACLE.update(scoped_queries.ORACLE)

from . import family_queries  # noqa: E402

QUERIES.update(family_queries.QUERIES)
ORACLE.update(family_queries.ORACLE)

from . import store_queries  # noqa: E402

QUERIES.update(store_queries.QUERIES)
ORACLE.update(store_queries.ORACLE)
