"""Numeric expressions whose result does not depend on row order or on the engine.

They take column names, not expressions: an intermediate result that is used several times gets
a name first, so Catalyst computes it once and the generated code stays small enough to be
compiled. Each call is one parsed expression, which also keeps plan building quick.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums are exact to twelve decimals; a total beyond 26 digits before the point is an error.
_SUM_TYPE = "decimal(38, 12)"
# From here on a double has no fractional digits left to round.
_DOUBLE_INTEGRAL = 2.0**52


def _double(value: float) -> str:
    return f"{value!r}D"


def round_half_up(column: str, digits: int) -> Column:
    """Round to ``digits`` places, halves away from zero, in plain double arithmetic.

    ``F.round`` goes through BigDecimal for every row and disagrees with other engines on
    values such as 1.005; this form is cheaper and reproducible. A value too large to have
    fractional digits at that place is already round and stays as it is.
    """
    scale = float(10**digits)
    return F.expr(
        f"case when abs(`{column}`) >= {_double(_DOUBLE_INTEGRAL / scale)} then `{column}` "
        f"else signum(`{column}`) * floor(abs(`{column}`) * {_double(scale)} + 0.5D) / {_double(scale)} + 0.0D end"
    )


def _special(column: str) -> str:
    return f"(isnan(cast(`{column}` as double)) or abs(cast(`{column}` as double)) = double('infinity'))"


def _exact_sum(column: str) -> str:
    special = _special(column)
    return (
        f"case when count_if({special}) > 0 then sum(case when {special} then cast(`{column}` as double) end) "
        f"else cast(sum(case when not {special} then cast(`{column}` as {_SUM_TYPE}) end) as double) end"
    )


def exact_sum(column: str) -> Column:
    """Sum of a numeric column, as a double, that does not depend on the order of the rows.

    Decimal addition is associative, and the fixed-width buffer still combines on the map side.
    NaN and infinity stay what they are in floating-point arithmetic; a total that does not fit is an
    error, never a rounded result.
    """
    return F.expr(_exact_sum(column))


def exact_avg(column: str) -> Column:
    """Mean over the non-null values, built on :func:`exact_sum`; null for an empty group."""
    return F.expr(f"({_exact_sum(column)}) / nullif(count(`{column}`), 0)")


def percent_of(part: str, whole: str) -> Column:
    """``100 * part / whole`` in double arithmetic, null when ``whole`` is zero."""
    return F.expr(f"100.0D * `{part}` / nullif(`{whole}`, 0)")


def _strict(function: str, first: str, bound: float) -> Column:
    return F.expr(f"case when `{first}` is not null then {function}(`{first}`, {_double(bound)}) end")


def at_most(column: str, ceiling: float) -> Column:
    """The value or the ceiling, whichever is less; null stays null (``least`` would skip it)."""
    return _strict("least", column, ceiling)


def at_least(column: str, floor: float) -> Column:
    """The value or the floor, whichever is greater; null stays null (``greatest`` would skip it)."""
    return _strict("greatest", column, floor)
