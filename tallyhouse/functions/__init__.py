"""Expressions shared by the operators; every one stays inside the JVM.

Most are SQL text for ``selectExpr``/``expr``: one call to the JVM each, where a chain of Column
operators makes one call per operator.
"""

from tallyhouse.functions.hashing import row_hash
from tallyhouse.functions.text import (
    aggregate,
    blank_to_null,
    count_where,
    divided,
    divided_if_positive,
    mean,
    minutes_between,
    not_in,
    or_zero,
    select,
    share_where,
    sums,
    tidy,
    two_digits,
    weighted_mean,
)

__all__ = [
    "aggregate",
    "blank_to_null",
    "count_where",
    "divided",
    "divided_if_positive",
    "mean",
    "minutes_between",
    "not_in",
    "or_zero",
    "row_hash",
    "select",
    "share_where",
    "sums",
    "tidy",
    "two_digits",
    "weighted_mean",
]
