"""Typed projections, row filters and small derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(df: DataFrame, target: T.StructType, source: Mapping[str, str | Column]) -> DataFrame:
    """Project raw columns to the declared names and types of a target table."""
    cols = []
    for field in target.fields:
        value = source[field.name]
        value = F.col(value) if isinstance(value, str) else value
        cols.append(value.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def ms_to_seconds(ms: Column) -> Column:
    return ms / F.lit(1000.0)


def to_percent(ratio: Column) -> Column:
    return ratio * F.lit(100.0)


def extract_window(df: DataFrame, extract_date: str, start: str, end: str) -> DataFrame:
    """Rows of one extract window; equality on the partition columns, so other folders are not read."""
    return df.filter(
        (F.col("extractDate") == F.to_date(F.lit(extract_date)))
        & (F.col("extractIntervalStartTime") == F.to_timestamp(F.lit(start)))
        & (F.col("extractIntervalEndTime") == F.to_timestamp(F.lit(end)))
    )


def half_open(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return df.filter((F.col(column) >= F.to_timestamp(F.lit(start))) & (F.col(column) < F.to_timestamp(F.lit(end))))


def without_listed(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose trimmed text is not on the exclusion list."""
    keys = listed.select(F.trim(listed_column).alias("_x")).distinct()
    return df.join(keys, F.trim(F.col(column)) == F.col("_x"), "left_anti")


def drop_empty(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Drop rows whose measures are all null or zero."""
    empty = reduce(lambda a, b: a & b, [F.coalesce(F.col(m), F.lit(0)) == 0 for m in measures])
    return df.filter(~empty)


def drop_zero_length(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(start) != F.col(end))


def status_of(deleted: Column, active: Column) -> Column:
    return F.when(deleted, "Deleted").when(active, "Active").otherwise("Inactive")


def region_slices(df: DataFrame, region_col: str, slices: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """All region sets of an export in one pass; a region may belong to several sets."""
    hits = [F.when(F.col(region_col).isin(*regions), F.lit(label)) for label, regions in slices.items()]
    return df.withColumn(name, F.explode(F.array_compact(F.array(*hits))))


def date_id(ts: Column) -> Column:
    """yyyyMMdd as an integer; arithmetic, which is much cheaper than formatting."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_id(ts: Column) -> Column:
    """HHmmss as an integer."""
    return F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def tenant_rows(df: DataFrame, tenant_col: str, tenant: str) -> DataFrame:
    return df.filter(F.col(tenant_col) == tenant).drop(tenant_col)
