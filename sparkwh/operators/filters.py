"""Predicates of the warehouse's queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import interval, parse_ts, ts


def between(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Closed range of timestamps. A bound without a time of day means its midnight, so a date as the upper bound
    leaves out the rest of that day."""
    return df.where(F.col(col).between(ts(lo), ts(hi)))


def between_dates_as_text(df: DataFrame, col: str, lo: str, hi: str, typed: bool = False,
                          fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Closed range over text dates, compared as text; ``typed`` parses first and drops what does not parse."""
    if typed:
        return df.where(parse_ts(F.col(col), fmt).between(ts(lo), ts(hi)))
    return df.where(F.col(col).between(lo, hi))


def recent(df: DataFrame, ts_col: str, as_of: str, span: str) -> DataFrame:
    """Rows later than ``as_of`` minus the span; the bound itself is out."""
    return df.where(F.col(ts_col) > ts(as_of) - interval(span))


def window_open_closed(df: DataFrame, col: str, low: Column | str, high: Column | str) -> DataFrame:
    """``low < col <= high``."""
    low = ts(low) if isinstance(low, str) else low
    high = ts(high) if isinstance(high, str) else high
    return df.where((F.col(col) > low) & (F.col(col) <= high))


def any_like(df: DataFrame, col: str, patterns: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(col).like(p) for p in patterns]))


def none_like(df: DataFrame, col: str, patterns: list[str]) -> DataFrame:
    """Rows whose value is known and fits none of the patterns."""
    return df.where(reduce(lambda a, b: a & b, [~F.col(col).like(p) for p in patterns]))


def one_of(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is in a given list; NULL is in none."""
    return df.where(F.col(col).isin(list(values)))


def differs(a: str, b: str, cols: list[str], null_safe: bool = True) -> Column:
    """True where any of ``cols`` differs between the two sides of a join aliased ``a`` and ``b``.

    With ``null_safe=False`` a change to or from NULL is not seen, as with a plain ``<>``.
    """
    def one(c: str) -> Column:
        left, right = F.col(f"{a}.{c}"), F.col(f"{b}.{c}")
        return ~left.eqNullSafe(right) if null_safe else F.coalesce(left != right, F.lit(False))
    return reduce(lambda x, y: x | y, [one(c) for c in cols])
