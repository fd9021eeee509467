"""Registered queries: a Spark function over the given tables and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return printable(self.build(Tables(spark, folder)))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` with the SQL that must give the same rows."""

    def add(build):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return add


def printable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that both engines show them alike."""
    timelike = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, timelike)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
