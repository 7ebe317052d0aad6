"""Number expressions. Scores are scaled integers, so every engine ranks them alike.

``_e9`` is a share times 10**9, ``_ppm`` times 10**6, ``_bp`` times 10**4; money is whole cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where an indicator's number stands in its text, at the front or before a capital.
LEAD_NUMBER = r"^\s*(\d+)\."
INNER_NUMBER = r"(?:^|\s)(\d{1,3})\.\s*[A-Z]"

E9 = 1_000_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a: Column | str, b: Column | str) -> Column:
    """Whole-number quotient; NULL for a zero or missing divisor."""
    return F.call_function("div", col(a), F.nullif(col(b), F.lit(0)))


def mul_div_sql(a: str, b: str | int, c: str | int) -> str:
    """``mul_div`` as SQL text, for wide projections built from names."""
    wide = [f"CAST({x} AS DECIMAL(19,0))" for x in (a, b, c)]
    return f"({wide[0]} * {wide[1]}) div nullif({wide[2]}, 0BD)"


def mul_div(a: Column | str, b: Column | str, c: Column | str) -> Column:
    """``a * b div c`` through a 38-digit product, so that a hot unit's totals cannot overflow."""
    if all(isinstance(x, str) for x in (a, b, c)):
        return F.expr(mul_div_sql(a, b, c))
    product = col(a).cast("decimal(19,0)") * col(b).cast("decimal(19,0)")
    return F.call_function("div", product, F.nullif(col(c).cast("decimal(19,0)"), F.lit(0)))


def mul_div_even(a: Column | str, b: Column | str, c: Column | str) -> Column:
    """``a * b / c`` rounded half to even on whole numbers (all non-negative)."""
    product = col(a).cast("decimal(19,0)") * col(b).cast("decimal(19,0)")
    by = F.nullif(col(c).cast("decimal(19,0)"), F.lit(0))
    low = F.call_function("div", product, by)
    twice = 2 * (product - low.cast("decimal(19,0)") * by)
    up = (twice > by) | ((twice == by) & (F.pmod(low, F.lit(2)) == 1))
    return low + F.when(up, F.lit(1)).otherwise(F.lit(0))


def cents(money: Column | str) -> Column:
    """Non-negative money to whole cents, per row and before any sum."""
    return (col(money) * 100 + 0.5).cast("long")


def clip(x: Column | str, low, high) -> Column:
    """Clip that keeps NULL missing; ``least``/``greatest`` alone would skip it."""
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """Quotient that is NULL, not an error, for a zero divisor."""
    return col(a) / F.nullif(col(b), F.lit(0))


def toward_need(value: Column | str, higher_is_worse: Column | str, top) -> Column:
    """Turn a value so that higher always means more need; ``top`` is the scale's upper end."""
    return F.when(col(higher_is_worse), col(value)).otherwise(F.lit(top) - col(value))


def ceil_div(a: Column | str, b: Column | str) -> Column:
    return div(col(a) + col(b) - 1, b)


def lenient(text: Column | str, to: str) -> Column:
    """Cast where markers for absent (``NA``) and suppressed (``*``) become NULL."""
    return col(text).try_cast(to)


def missing_flag(text: Column | str) -> Column:
    """Why a value is missing: the two markers are different facts."""
    t = F.trim(col(text))
    return (F.when(t == "*", F.lit("suppressed"))
            .when(t.isNull() | (t == "NA"), F.lit("absent"))
            .otherwise(F.lit("present")))


def leading_number(text: Column | str) -> Column:
    """Leading item number of a label, else one that a merged header pushed inside it."""
    lead = F.nullif(F.regexp_extract(col(text), LEAD_NUMBER, 1), F.lit(""))
    inner = F.nullif(F.regexp_extract(col(text), INNER_NUMBER, 1), F.lit(""))
    return F.coalesce(lead, inner).try_cast("int")
