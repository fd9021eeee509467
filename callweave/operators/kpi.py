"""KPIs configured as formula texts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: aggregations and scalar functions a formula may use
AGGREGATIONS = {"sum", "avg", "min", "max", "count"}
FUNCTIONS = {"coalesce", "abs", "nullif", "greatest", "least", "round"}

_TOKEN = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|([A-Za-z_]\w*)|([()+\-*/,]))")


class BadFormula(ValueError):
    """A configured formula uses something outside the allow-list."""


@dataclass(frozen=True)
class Formula:
    """``num_aggr(num) / denom_aggr(denom)``, reported under ``key``."""

    key: str
    num: str
    num_aggr: str
    denom: str
    denom_aggr: str


def checked(text: str, columns: Sequence[str]) -> str:
    """The formula text, if it holds only numbers, arithmetic, known columns and allowed functions."""
    at = 0
    text = text.strip()
    if "--" in text or "/*" in text:
        raise BadFormula(f"comment in {text!r}")
    while at < len(text):
        token = _TOKEN.match(text, at)
        if not token:
            raise BadFormula(f"unexpected text at {text[at:]!r}")
        word = token.group(2)
        if word and word not in columns and word.lower() not in FUNCTIONS:
            raise BadFormula(f"unknown name {word!r}")
        at = token.end()
    return text


def _aggregate(name: str, text: str):
    if name.lower() not in AGGREGATIONS:
        raise BadFormula(f"unknown aggregation {name!r}")
    return F.expr(f"{name.lower()}({text})")


def ratio_kpis(df: DataFrame, formulas: Sequence[Formula], keys: Sequence[str]) -> DataFrame:
    """Numerator and denominator of every formula in one pass over the data, a row per key and formula.

    A row counts for a formula only when both its parts are not null, and a group without a value for
    both is left out.
    """
    aggs, names = [], []
    for i, f in enumerate(formulas):
        num, denom = checked(f.num, df.columns), checked(f.denom, df.columns)
        both = f"({num}) is not null and ({denom}) is not null"
        aggs.append(_aggregate(f.num_aggr, f"case when {both} then {num} end").cast("double").alias(f"_n{i}"))
        aggs.append(_aggregate(f.denom_aggr, f"case when {both} then {denom} end").cast("double").alias(f"_d{i}"))
        names.append(F.struct(F.lit(f.key).alias("dictionary_key"), F.col(f"_n{i}").alias("num"), F.col(f"_d{i}").alias("denom")))
    wide = df.groupBy(*keys).agg(*aggs)
    rows = wide.select(*keys, F.explode(F.array(*names)).alias("_kpi")).select(*keys, "_kpi.*")
    return rows.filter("num is not null and denom is not null").withColumn("value", F.try_divide("num", "denom"))


def own_value_kpis(df: DataFrame, aggregations: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """KPIs that are one aggregated column: ``aggregations`` goes from column to aggregation name."""
    cols = list(aggregations)
    for c in cols:
        checked(c, df.columns)
    wide = df.groupBy(*keys).agg(*[_aggregate(a, c).cast("double").alias(c) for c, a in aggregations.items()])
    return wide.unpivot(list(keys), cols, "dictionary_key", "value").filter("value is not null")


def high_water_mark(df: DataFrame, org: str, created: str) -> DataFrame:
    return df.groupBy(org).agg(F.max(created).alias("last_processed_date"))


def newer_than_mark(df: DataFrame, marks: DataFrame, org: str, created: str) -> DataFrame:
    """Rows created after the mark of their org; an org without a mark is taken whole."""
    out = df.join(marks, org, "left")
    mark = F.col("last_processed_date")
    return out.filter(mark.isNull() | (F.col(created) > mark)).drop("last_processed_date")
