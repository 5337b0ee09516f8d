"""Column-level business rules, all built from JVM-side functions.

Nothing in here is a Python UDF: each helper returns a ``Column`` so it stays
inside whole-stage codegen and can be used identically in batch and streaming
plans.

Rounding.  Reports round averages and shares HALF_UP.  Averaging doubles and
rounding the result is engine- and order-dependent at ties, so averages are an
exact ratio: values are summed as decimals (six places kept; NaN and infinities
count as missing) and the ratio is rounded once, in whole numbers.  The final
division by a power of ten returns the nearest double to the exact result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- fixed values that must match the reference's rules ----------------------
# Age bands: < 25 -> 18-24, < 35 -> 25-34, < 45 -> 35-44, otherwise 45+.
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44")]
AGE_BAND_DEFAULT = "45+"
COMPLETED_PCT = 90          # is_completed threshold
PREMIUM_PLAN = "premium"
HIGH_PCT = 80               # HIGH engagement / binge watcher / notify
MEDIUM_PCT = 50             # MEDIUM engagement / engaged
LONG_SESSION_MINS = 120     # long-session notification above this
VALID_PLANS = ["free", "basic", "standard", "premium"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- flags and labels ---------------------------------------------------------

def age_group(age: str | Column) -> Column:
    """4-band age bucket; NULL age falls through to ``45+``."""
    a = _c(age)
    out = None
    for bound, label in AGE_BANDS:
        out = F.when(a < bound, label) if out is None else out.when(a < bound, label)
    return out.otherwise(AGE_BAND_DEFAULT)


def is_completed(pct: str | Column) -> Column:
    return F.coalesce(_c(pct) >= COMPLETED_PCT, F.lit(False))


def is_premium(plan: str | Column) -> Column:
    return F.coalesce(_c(plan) == PREMIUM_PLAN, F.lit(False))


def at_least(c: Column, bound: float) -> Column:
    """``c >= bound`` with NaN false (Spark orders NaN above every number)."""
    return (c >= bound) & ~F.isnan(c.cast("double"))


def engagement_level(pct: str | Column) -> Column:
    p = _c(pct)
    return F.when(at_least(p, HIGH_PCT), "HIGH").when(at_least(p, MEDIUM_PCT), "MEDIUM").otherwise("LOW")


def engagement_score(pct: str | Column, mins: str | Column) -> Column:
    """60 % completion + 40 % duration (capped at two hours), 1 decimal.

    With completion at one decimal and whole minutes, the unrounded score can
    never sit exactly on a rounding tie, so plain ``round`` is exact here.
    """
    duration = F.least(_c(mins) / F.lit(120.0) * F.lit(100.0), F.lit(100.0))
    return F.round(_c(pct) * F.lit(0.6) + duration * F.lit(0.4), 1)


# -- exact HALF_UP rounding -----------------------------------------------------

DECIMALS = 6                # kept of a fractional input before it is summed


def half_up_sql(num: str, den: str, scale: int) -> str:
    """SQL text: ``num / den`` rounded HALF_UP to ``scale`` decimals, as DOUBLE.

    ``num`` and ``den`` must be integral SQL expressions, ``den`` > 0 (0 gives
    NULL).  Whole-number arithmetic, so the result does not depend on summation
    order or on how an engine rounds binary doubles; 38 digits do not overflow
    where BIGINT would.
    """
    p = 10 ** scale
    n, d = f"CAST({num} AS DECIMAL(38,0))", f"CAST({den} AS DECIMAL(38,0))"
    return (
        f"CAST(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * "
        f"((2 * abs({n}) * {p} + {d}) div nullif(2 * {d}, 0)) AS DOUBLE) / {p}D"
    )


def half_up(num: str, den: str, scale: int) -> Column:
    return F.expr(half_up_sql(num, den, scale))


def exact_sql(col: str) -> str:
    """A fractional column as an exact decimal; NaN and infinities are NULL."""
    return f"try_cast({col} AS DECIMAL(18,{DECIMALS}))"


def avg_half_up_sql(col: str, in_scale: int, out_scale: int) -> str:
    """SQL text of an aggregate: exact mean of ``col``, rounded HALF_UP once.  ``in_scale`` 0
    says the column is whole-numbered; others are summed at DECIMALS decimals."""
    if in_scale == 0:
        return half_up_sql(f"sum(CAST({col} AS BIGINT))", f"count({col})", out_scale)
    return half_up_sql(f"sum({exact_sql(col)}) * {10 ** DECIMALS}", f"count({exact_sql(col)}) * {10 ** DECIMALS}",
                       out_scale)


def avg_half_up(col: str, in_scale: int, out_scale: int) -> Column:
    return F.expr(avg_half_up_sql(col, in_scale, out_scale))


def sum_scaled(col: str, in_scale: int) -> Column:
    """Aggregate: exact sum, as BIGINT of a whole-numbered column, else as DOUBLE."""
    if in_scale == 0:
        return F.expr(f"sum(CAST({col} AS BIGINT))")
    return F.expr(f"CAST(sum({exact_sql(col)}) AS DOUBLE)")


def share_pct(part: str, total: str, scale: int = 1) -> Column:
    """``part * 100 / total`` rounded HALF_UP (integral inputs)."""
    return half_up(f"({part}) * 100", total, scale)
