"""SQL text helpers: text tidying, guarded ratios, exact means, and select/aggregate by text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select(rows: DataFrame, *items: str) -> DataFrame:
    """``selectExpr`` over comma-free items or whole comma-separated lists of plain names."""
    flat = [name.strip() for item in items for name in (item.split(",") if _is_list(item) else [item])]
    return rows.selectExpr(*flat)


def _is_list(item: str) -> bool:
    return all(part.strip().replace("_", "").isalnum() for part in item.split(","))


def aggregate(rows: DataFrame, by: Sequence[str], *items: str) -> DataFrame:
    """Groups by columns (or all rows by none) and aggregates by SQL text."""
    return rows.groupBy(*by).agg(*[F.expr(item) for item in items])


def tidy(name: str) -> str:
    """Trimmed, lower-case label."""
    return f"lower(trim({name})) as {name}"


def blank_to_null(name: str) -> str:
    """Trimmed text, NULL when nothing is left."""
    return f"nullif(trim({name}), '') as {name}"


def divided(top: str, bottom: str) -> str:
    """Quotient as double, NULL when the divisor is zero or missing."""
    return f"try_divide(cast({top} as double), cast({bottom} as double))"


def divided_if_positive(top: str, bottom: str) -> str:
    """Quotient as double, only where the divisor is above zero."""
    return f"case when {bottom} > 0 then cast({top} as double) / cast({bottom} as double) end"


def mean(value: str) -> str:
    """Average as double of an exact sum, so decimals lose no digits to a rounded decimal average."""
    return divided(f"sum({value})", f"count({value})")


def weighted_mean(value: str, weight: str) -> str:
    return divided(f"sum({value} * {weight})", f"sum({weight})")


def count_where(condition: str) -> str:
    """Rows for which the condition holds; NULL counts as not holding."""
    return f"count_if({condition})"


def share_where(condition: str) -> str:
    """Share of all rows for which the condition holds; NULL counts as not holding."""
    return divided(f"count_if({condition})", "count(*)")


def sums(*names: str) -> list[str]:
    return [f"sum({name}) as {name}" for name in names]


def or_zero(*names: str) -> list[str]:
    return [f"coalesce({name}, 0) as {name}" for name in names]


def not_in(name: str, allowed: Iterable[str]) -> str:
    """True where the value, NULL included, is not one of a closed set."""
    listed = ", ".join(f"'{value}'" for value in allowed)
    return f"not coalesce({name} in ({listed}), false)"


def two_digits(value: str) -> str:
    """A non-negative double rounded to two digits as Python rounds it: by its exact binary value, ties to even.

    The double is split into halves whose products by 200 are exact, which gives its number of half cents and what that
    number misses.  An odd number of half cents lies between two cents: the rest decides, or without one the even cent.
    """
    high = "(x * 134217729D - (x * 134217729D - x))"
    halves = f"transform(array({value}), x -> struct(x * 200D as h, ({high} * 200D - x * 200D) + (x - {high}) * 200D as rest))[0]"
    cents = (
        "case when s.h <> floor(s.h) then floor((floor(s.h) + 1) / 2) when s.h % 2 = 0 then s.h / 2 when s.rest < 0 then (s.h - 1) / 2 "
        "when s.rest > 0 then (s.h + 1) / 2 else 2 * floor((s.h + 1) / 4) end"
    )
    return f"double(transform(array({halves}), s -> {cents})[0]) / 100D"


def minutes_between(start: str, end: str) -> str:
    """Elapsed minutes between two timestamps, to the microsecond."""
    return f"(unix_micros(cast({end} as timestamp)) - unix_micros(cast({start} as timestamp))) / 60000000.0D"
