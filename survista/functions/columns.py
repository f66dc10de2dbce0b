"""Scalar Column helpers (SF1-SF16, predicate helpers FI6-FI10, PJ2, PJ4, WN5).

Everything here returns a native Catalyst expression, so it stays inside
whole-stage codegen; there are no Python UDFs in the library.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- fixed values -----------------------------------------------------------
# Fixed values that must equal the reference's: the substrings removed from
# free-text answers before a spreadsheet export, in the order they are removed.
CLEAN_TEXT_REMOVALS = ("<span>", "</span>", "<p>", "</p>", "&nbsp", ";", "\r\n", "\r", "\n")
# Subtotal labels used by the reports' rollups.
STATE_TOTAL = "State Total"
AU_TOTAL = "Admin Unit Total"
DISTRICT_TOTAL = "District Total"
# Sentinel used by the single-student checklist filter.
NULL_SENTINEL = "xyz123abc"


# -- text (SF2, SF3, SF4, SF5, SF6, SF9, SF13, SF14) -----------------------------
def clean_text(c: ColumnOrName) -> Column:
    """Strip the fixed HTML fragments and line breaks, exactly (not a general
    HTML stripper)."""
    out = col(c)
    for s in CLEAN_TEXT_REMOVALS:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def roster_year_label(start_year: ColumnOrName, sep: str = "-") -> Column:
    """'2014-15' (sep='-') or '2014 - 15' (sep=' - ') from the start year."""
    y = col(start_year)
    return F.concat(y.cast("string"), F.lit(sep), F.right((y + 1).cast("string"), F.lit(2)))


def left_n(c: ColumnOrName, n: int) -> Column:
    """``cast(x as varchar(n))`` truncation (Spark's varchar cast does not truncate)."""
    return F.left(col(c).cast("string"), F.lit(n))


def pad_left(c: ColumnOrName, n: int) -> Column:
    """``right(' ' + x, n)``: left pad with one blank, keep the last n chars."""
    return F.right(F.concat(F.lit(" "), col(c).cast("string")), F.lit(n))


def us_date(c: ColumnOrName) -> Column:
    """Date as ``MM/dd/yyyy`` text (style 101). ``max`` over it is lexicographic."""
    return F.date_format(col(c), "MM/dd/yyyy")


def flag_text(c: ColumnOrName) -> Column:
    """bit -> '1'/'0' (a plain boolean cast would give 'true')."""
    return col(c).cast("int").cast("string")


def money_text(c: ColumnOrName) -> Column:
    """money -> varchar prints two decimals."""
    return col(c).cast("decimal(19,2)").cast("string")


# -- arithmetic (SF7, SF8, SF11, SF12, S5, S14) -----------------------------------
def div_floor(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integral division of non-negative integers (SQL ``a div b``)."""
    return F.call_function("div", col(a).cast("long"), col(b).cast("long"))


def ratio_half_up(num: ColumnOrName, den: ColumnOrName, scale: int = 2,
                  precision: int = 38, times: int = 1) -> Column:
    """Exact ``round(times * num / den, scale)`` (HALF_UP) for integer num >= 0,
    den > 0, as a decimal(precision, scale).

    Done in integer arithmetic, so no binary-float tie can flip the last digit
    and the same value comes out of any SQL engine.
    """
    unit = 10 ** scale
    n = col(num).cast("long")
    d = col(den).cast("long")
    q = div_floor(n * F.lit(2 * unit * times) + d, d * F.lit(2))
    step = F.lit(Decimal(1).scaleb(-scale))
    return F.when(d != 0, (q.cast("decimal(38,0)") * step).cast(f"decimal({precision},{scale})"))


def pct_of(num: ColumnOrName, den: ColumnOrName, scale: int = 2, precision: int = 5) -> Column:
    """``cast(round(num*100.0/den, scale) as decimal(precision, scale))``."""
    return ratio_half_up(num, den, scale=scale, precision=precision, times=100)


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division that yields NULL on a zero divisor (the CASE guard of S14)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def likert(option_sequence: ColumnOrName) -> Column:
    """Likert score = option sequence + 1."""
    return col(option_sequence) + F.lit(1)


def weighted(option_sequence: ColumnOrName, weight: ColumnOrName) -> Column:
    """Weighted score = (sequence + 1) * weight; NULL when the weight is NULL."""
    return (col(option_sequence) + F.lit(1)) * col(weight)


# -- predicates (FI6-FI10) ---------------------------------------------------------
def optional_eq(c: ColumnOrName, value, all_value: str = "All", width: int | None = 10) -> Column:
    """``@p = 'All' or left(col, width) = @p``; folds to TRUE when value is 'All'."""
    if value is None or value == all_value:
        return F.lit(True)
    lhs = left_n(c, width) if width else col(c)
    return lhs == F.lit(value)


def null_or_eq(c: ColumnOrName, value) -> Column:
    return col(c).isNull() | (col(c) == F.lit(value))


def eq_null_sentinel(c: ColumnOrName, value, sentinel: str = NULL_SENTINEL) -> Column:
    return F.coalesce(col(c), F.lit(sentinel)) == F.lit(value)


def contains_ci(c: ColumnOrName, text: str) -> Column:
    """``like '%text%'`` under a case-insensitive collation."""
    return col(c).ilike(f"%{text}%")


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)


# -- value mapping (PJ2, PJ4) ------------------------------------------------------
def map_values(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Simple CASE: ``case c when k1 then v1 ... else default end``."""
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = F.when(col(c) == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(col(c) == F.lit(k), F.lit(v))
    return expr.otherwise(col(c) if default is _KEEP else F.lit(default))


_KEEP = object()
KEEP = _KEEP  # pass as ``default`` to keep unmapped values


def merge_buckets(c: ColumnOrName, groups: Iterable[Iterable[str]]) -> Column:
    """Merge listed codes into one bucket label: ('006','007') -> '006,007'."""
    expr = None
    for g in groups:
        g = list(g)
        label = ",".join(g)
        expr = (F.when if expr is None else expr.when)(col(c).isin(g), F.lit(label))
    return col(c) if expr is None else expr.otherwise(col(c))


# -- ordering (WN5) ----------------------------------------------------------------
def nulls_last(c: ColumnOrName, desc: bool = False) -> Column:
    return col(c).desc_nulls_last() if desc else col(c).asc_nulls_last()


def round_dec(c: ColumnOrName, scale: int = 2, precision: int = 38) -> Column:
    """``round(x, scale)`` of a double as an exact decimal: first to 10
    digits (absorbs binary noise), then HALF_UP to ``scale``."""
    return col(c).cast("decimal(38,10)").cast(f"decimal({precision},{scale})")


def float_text(c: ColumnOrName) -> Column:
    """float -> varchar without a trailing '.0' for whole numbers (6.0 -> '6')."""
    x = col(c)
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))
