"""Roll-ups and conditional aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sums(df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, str]) -> DataFrame:
    """Sum measures to the grain of ``keys``; ``sums`` goes from result to source column."""
    return df.groupBy(*keys).agg(*[F.sum(src).alias(new) for new, src in sums.items()])


def count_positive(x: str | Column) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.count_if(F.coalesce(x, F.lit(0)) > 0)


def sum_where(condition: Column, x: str | Column) -> Column:
    return F.sum(F.when(condition, F.col(x) if isinstance(x, str) else x))


def ratio(num: Column, denom: Column) -> Column:
    """Quotient, null when the denominator is zero or null."""
    return F.try_divide(num.cast("double"), denom.cast("double"))


def capped_avg(x: Column, cap: float = 100.0) -> Column:
    return F.least(F.avg(x), F.lit(cap))


def text_lists(df: DataFrame, keys: Sequence[str], column: str, name: str, sep: str = ",") -> DataFrame:
    """Distinct values per key as sorted joined text; duplicates go before the values are gathered."""
    once = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    return once.groupBy(*keys).agg(F.concat_ws(sep, F.array_sort(F.collect_list(column))).alias(name))


def assemble_lines(
    df: DataFrame, key: str, line: str, text: Column, name: str, lines_per_part: int
) -> DataFrame:
    """Transcript text per conversation and part, lines in order.

    Part n holds the lines n * ``lines_per_part`` + 1 and following, so the grain is the caller's and one
    group never holds more than that many lines; nothing is dropped.
    """
    part = F.floor((F.col(line) - 1) / lines_per_part).cast("int")
    return (
        df.groupBy(key, part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(line).alias("n"), text.alias("t")))).alias("_lines"))
        .select(key, "part", F.concat_ws("\n", F.col("_lines.t")).alias(name))
    )


def spans(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(start).alias("firstStart"), F.max(end).alias("lastEnd"))
