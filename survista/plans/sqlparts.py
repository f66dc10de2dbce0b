"""SQL text shared by the DuckDB oracle queries: the same stand-in mapping as
``survista.sources.proxy`` and the exact-percent expression of
``survista.functions.ratio_half_up``, spelled in plain SQL."""

from __future__ import annotations

from ..sources.proxy import DISABILITY_CODES, GENDER_CODES, GRANTS, QUESTION_WEIGHTS


def values(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({cols})"


def ratio_half_up(num: str, den: str, scale: int = 2, precision: int = 38, times: int = 1) -> str:
    unit = 10 ** scale
    step = "0." + "0" * (scale - 1) + "1" if scale > 0 else "1"
    d = f"NULLIF(CAST({den} AS BIGINT), 0)"
    q = f"((CAST({num} AS BIGINT) * {2 * unit * times} + {d}) // (2 * {d}))"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * {step} AS DECIMAL({precision},{scale}))"


def pct_of(num: str, den: str, scale: int = 2, precision: int = 5) -> str:
    return ratio_half_up(num, den, scale=scale, precision=precision, times=100)


INST = """
    SELECT o.o_orderkey AS instance_id, r.r_regionkey AS org_unit_id, r.r_name AS au,
           n.n_name AS district, c.c_mktsegment AS school, o.o_orderpriority AS priority,
           o.o_orderstatus AS language, CAST(year(o.o_orderdate) AS INTEGER) AS roster_year,
           o.o_orderdate AS order_date
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""

RK = """
    SELECT instance_id, org_unit_id, au, roster_year, 'DISTRICT' AS attribute_id, district AS value FROM inst
    UNION ALL SELECT instance_id, org_unit_id, au, roster_year, 'SCHOOL', school FROM inst
    UNION ALL SELECT instance_id, org_unit_id, au, roster_year, 'DISABILITY', substr(priority, 1, 1) FROM inst
    UNION ALL SELECT instance_id, org_unit_id, au, roster_year, 'GENDER', language FROM inst
    UNION ALL SELECT instance_id, org_unit_id, au, roster_year, 'YEAR', CAST(roster_year AS VARCHAR) FROM inst"""

ANS = """
    SELECT l_orderkey AS instance_id, l_linenumber AS attribute_id,
           CASE l_returnflag WHEN 'A' THEN 'Met' WHEN 'R' THEN 'Not Met' ELSE 'Not Applicable' END AS value,
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(ceil(l_quantity / 10) AS INTEGER) END AS likert,
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(ceil(l_quantity / 10) AS INTEGER) - 1 END AS option_sequence,
           l_linestatus AS match
    FROM lineitem"""

GRANTS_SQL = values(GRANTS, "user_profile_id, org_unit_id")
DISAB_SQL = values(DISABILITY_CODES, "code, name")
GENDER_SQL = values(GENDER_CODES, "code, name")
WEIGHTS_SQL = values(QUESTION_WEIGHTS, "question, report_weight")


def with_base(*parts: str) -> str:
    """``WITH inst AS (...), rk AS (...), ans AS (...)`` prefix plus extra CTEs."""
    ctes = [f"inst AS ({INST})", f"rk AS ({RK})", f"ans AS ({ANS})"] + list(parts)
    return "WITH " + ",\n".join(ctes) + "\n"
