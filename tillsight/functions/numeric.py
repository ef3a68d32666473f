"""Arithmetic that gives the same digits on every engine and for every row order.

Averages are an exact sum divided once; rounding goes through ``floor`` so that a value on
a tie does not depend on how an engine rounds decimals.  A string argument is the text of a
SQL expression, which Spark parses in one call; a Column works as well.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Value = str | Column


def _col(c: Value) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def ratio_sql(num: str, den: str) -> str:
    """Text of :func:`ratio`."""
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0D))"


def _mean_sql(x: str) -> str:
    return ratio_sql(f"sum({x})", f"count({x})")


def round_half_up(x: Value, digits: int = 2) -> Column:
    """Round a DOUBLE half away from zero; NULL stays NULL."""
    if isinstance(x, str):
        v, s = f"CAST({x} AS DOUBLE)", f"{10**digits}D"
        return F.expr(f"signum({v}) * floor(abs({v}) * {s} + 0.5D) / {s} + 0D")
    v, scale = x.cast("double"), F.lit(float(10**digits))
    return F.signum(v) * F.floor(F.abs(v) * scale + 0.5) / scale + 0.0


def ratio(num: Value, den: Value) -> Column:
    """``num / den`` as DOUBLE; NULL where the denominator is zero or NULL."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(ratio_sql(num, den))
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def percent(num: Value, den: Value, digits: int = 2) -> Column:
    """``num`` as a rounded percentage of ``den``."""
    if isinstance(num, str) and isinstance(den, str):
        return round_half_up(ratio_sql(f"CAST({num} AS DOUBLE) * 100D", den), digits)
    return round_half_up(ratio(_col(num).cast("double") * 100.0, den), digits)


def relative_difference(x: str, base: str, digits: int = 2) -> Column:
    """Rounded percentage by which ``x`` lies above ``base``."""
    return round_half_up(f"{ratio_sql(f'CAST({x} AS DOUBLE) - CAST({base} AS DOUBLE)', base)} * 100D", digits)


def exact_mean(x: Value) -> Column:
    """Aggregate: mean of an INT or DECIMAL column, independent of row order."""
    return F.expr(_mean_sql(x)) if isinstance(x, str) else ratio(F.sum(x), F.count(x))


def mean(x: Value, digits: int = 2) -> Column:
    """Aggregate: rounded :func:`exact_mean`."""
    return round_half_up(_mean_sql(x) if isinstance(x, str) else exact_mean(x), digits)


def total(x: Value) -> Column:
    """Aggregate: exact sum, handed over as DOUBLE."""
    return F.sum(_col(x)).cast("double")


def sample_stddev(x: str, digits: int = 2) -> Column:
    """Aggregate: rounded sample standard deviation; NULL for a single row."""
    return round_half_up(f"stddev_samp(CAST({x} AS DOUBLE))", digits)


def count_where(condition: Value) -> Column:
    """Aggregate: rows for which the condition holds (NULL counts as not holding)."""
    return F.count_if(_col(condition))


def share_where(condition: Value, digits: int = 2) -> Column:
    """Aggregate: percentage of rows for which the condition holds."""
    if isinstance(condition, str):
        return percent(f"count_if({condition})", "count(1)", digits)
    return percent(F.count_if(condition), F.count(F.lit(1)), digits)


def flag(condition: Value) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.coalesce(_col(condition).cast("int"), F.lit(0))
