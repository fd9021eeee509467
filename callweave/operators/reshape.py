"""Pivots and unpivots with a declared list of names, so that the result has a fixed schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sum(df: DataFrame, keys: Sequence[str | Column], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One summed column per metric name; a name without rows is null."""
    sums = [F.sum(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names]
    return df.groupBy(*keys).agg(*sums)


def pivot_stats(df: DataFrame, keys: Sequence[str], name: str, names: Sequence[str], **aggs: Column) -> DataFrame:
    """Several aggregates per name: columns ``<name>_<aggregate>``."""
    return df.groupBy(*keys).pivot(name, list(names)).agg(*[a.alias(n) for n, a in aggs.items()])


def pivot_value(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Key/value rows to columns; of several values of a key the greatest counts. Names map key -> column."""
    cols = [F.max(F.when(F.col(name) == k, F.col(value))).alias(new) for k, new in names.items()]
    return df.groupBy(*keys).agg(*cols)


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def serial_day(number: Column) -> Column:
    """Spreadsheet serial number to date."""
    return F.date_add(F.to_date(F.lit("1899-12-30")), number.cast("int"))


def attribute_rows(df: DataFrame, ids: Sequence[str], attributes: str, skip: Sequence[str] = ()) -> DataFrame:
    """Dynamic attributes to rows, each with its ``<key>_num`` and ``<key>_denom`` companions."""
    entry = df.select(*ids, F.explode(attributes).alias("attr_dict_key", "attr_value"), F.col(attributes).alias("_m"))
    key = F.col("attr_dict_key")
    return entry.filter(~key.rlike("_(num|denom)$") & ~key.isin(*skip, "")).select(
        *ids,
        "attr_dict_key",
        "attr_value",
        F.try_element_at("_m", F.concat(key, F.lit("_num"))).alias("num"),
        F.try_element_at("_m", F.concat(key, F.lit("_denom"))).alias("denom"),
    )
