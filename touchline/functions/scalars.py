"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fraction(text: str) -> str:
    """'a/b' as struct<num,den>, in SQL; null for anything else. A zero denominator is kept."""
    num, den = (f"try_cast(substring_index({text}, '/', {side}) AS int)" for side in (1, -1))
    parts = f"transform(split({text}, '/'), p -> try_cast(trim(p) AS int))"
    usual = f"concat(cast({num} AS string), '/', cast({den} AS string)) = {text}"  # no patterns and lambdas for most
    return f"CASE WHEN {usual} THEN named_struct('num', {num}, 'den', {den}) ELSE {_any_fraction(parts)} END"


def _any_fraction(parts: str) -> str:
    return f"transform(array({parts}), f -> CASE WHEN size(f) = 2 AND f[0] IS NOT NULL AND f[1] IS NOT NULL THEN named_struct('num', f[0], 'den', f[1]) END)[0]"


def epoch_utc(seconds: Column) -> Column:
    """Seconds since 1970 as a timestamp; null and 0 give null."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def safe_get(parent: Column, child: str, default: Column | None = None) -> Column:
    """A member; the default stands for a null parent only."""
    return F.when(parent.isNull(), default if default is not None else F.lit(None)).otherwise(parent[child])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: inside lambdas nothing else
    keeps Spark from working a repeated subexpression out again and again."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each worked out once a row.

    They come from a generator of one row, through which the optimizer moves no
    filter: else a filter on a parsed column would carry the whole parsing
    expression, once for every mention, down to the scan.
    """
    out = df.select("*", F.inline(F.array(F.struct(*(v.alias(f"_new_{k}") for k, v in columns.items())))))
    return out.drop(*columns).withColumnsRenamed({f"_new_{k}": k for k in columns})
