"""The three rounding rules in use, and means built on them.

``half_up``    ties go towards +infinity    (display values, deviations)
``half_away``  ties go away from zero       (batch and hourly rollups)
``half_even``  ties go to the even digit    (national averages)

Arguments are column names or SQL text. Each ``*_sql`` function gives the expression as text, so
rules nest without a round trip to the JVM per operator and serve SQL functions as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_sql(x: str, digits: int = 1) -> str:
    scale = f"{10.0**digits!r}D"
    return f"(floor(({x}) * {scale} + 0.5D) / {scale})"


def half_away_sql(x: str, digits: int) -> str:
    return f"round({x}, {digits})"


def half_even_sql(x: str, digits: int) -> str:
    return f"bround({x}, {digits})"


_ROUNDERS = {"up": half_up_sql, "away": half_away_sql, "even": half_even_sql}


def _floor_div(num: str, den: str) -> str:
    """Floor division of integers, null for a zero divisor."""
    return f"((({num}) - pmod({num}, nullif({den}, 0L))) div nullif({den}, 0L))"


def mean_of_sum_sql(total: str, n: str, digits: int, ties: str = "away") -> str:
    """Rounded mean of a floating sum and a count."""
    return _ROUNDERS[ties](f"try_divide({total}, {n})", digits)


def mean_of_units_sql(units: str, n: str, digits: int, scale: int, ties: str = "away") -> str:
    """Rounded mean of an integer sum of 10**-scale units: exact, whatever the row order was."""
    unit = f"{10 ** (scale - digits)}L * {n}"
    if ties == "up":
        rounded = _floor_div(f"2L * {units} + {unit}", f"2L * {unit}")
    elif ties == "away":
        size = _floor_div(f"2L * abs({units}) + {unit}", f"2L * {unit}")
        rounded = f"CASE WHEN {units} < 0 THEN -{size} ELSE {size} END"
    elif ties == "even":
        below = _floor_div(units, unit)
        rest = f"2L * ({units} - {below} * {unit})"
        odd = f"pmod({below}, 2L)"
        rounded = (
            f"{below} + CASE WHEN {rest} > {unit} THEN 1L WHEN {rest} = {unit} THEN {odd} ELSE 0L END"
        )
    else:
        raise ValueError(f"unknown tie rule {ties!r}")
    return f"(({rounded}) / {10.0**digits!r}D)"


def units_sql(x: str, scale: int) -> str:
    """Fixed-point value as a whole number of 10**-scale units."""
    return f"CAST(rint(({x}) * {10.0**scale!r}D) AS BIGINT)"


def mean_sql(x: str, digits: int, how: str = "fixed", scale: int = 6, ties: str = "away") -> str:
    if how == "double":
        return _ROUNDERS[ties](f"avg({x})", digits)
    if how == "fixed":
        return mean_of_units_sql(f"sum({units_sql(x, scale)})", f"count({x})", digits, scale, ties)
    raise ValueError(f"unknown mean {how!r}")


def half_up(x: str, digits: int = 1) -> Column:
    return F.expr(half_up_sql(x, digits))


def half_away(x: str, digits: int) -> Column:
    return F.expr(half_away_sql(x, digits))


def half_even(x: str, digits: int) -> Column:
    return F.expr(half_even_sql(x, digits))


def mean(x: str, digits: int, how: str = "fixed", scale: int = 6, ties: str = "away") -> Column:
    """Aggregate: rounded mean of ``x``.

    ``how='fixed'``, which jobs and queries use, sums whole 10**-scale units, so re-runs and
    recovered tasks give one answer, exact for readings with at most ``scale`` decimals. A sum
    beyond 64 bits is an error, never a wrong value (values up to 1000: four billion rows a group).
    ``how='double'`` rounds ``avg(x)``, whose last bits depend on the order rows are summed in.
    """
    return F.expr(mean_sql(x, digits, how, scale, ties))
