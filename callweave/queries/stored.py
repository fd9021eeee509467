"""Stored side of an upsert query: old values that the batch must replace, and keys that it does not hold and must leave."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators import joins as jn
from callweave.operators import upserts as up
from callweave.session import cut_lineage, scratch_path


def stored_side(fresh: DataFrame, key: str, other_key: Column, old: dict[str, object], where: str = "true", spread: bool = False) -> DataFrame:
    """``fresh`` with the values of ``old`` where ``where`` holds, once under its own keys and once under ``other_key``. Where
    ``fresh`` is ``spread`` finely by ``key`` already, so are all the rows."""
    fresh = fresh.filter(where)
    types = {f.name: f.dataType for f in fresh.schema.fields}
    stale = fresh.withColumns({c: F.lit(v).cast(types[c]) for c, v in old.items()})
    others = stale.withColumn(key, other_key.cast(types[key]))
    return stale.unionByName(jn.spread_finely(others, key) if spread else others)


def stored_sql(prefix: str, select: str, key: str, other_key: str, old: dict[str, str], where: str = "true") -> str:
    """The batch and the stored rows under other keys; ``prefix`` is empty or a WITH clause, ``select`` gives the batch."""
    parts = [f"{other_key} AS {key}", *[f"{v} AS {c}" for c, v in old.items()]]
    start = f"{prefix}, fresh AS" if prefix else "WITH fresh AS"
    return f"{start} ({select}) SELECT * FROM fresh UNION ALL SELECT * REPLACE ({', '.join(parts)}) FROM fresh WHERE {where}"


def loaded(fresh: DataFrame, part: str, far: object, change: Callable, key: str, other_key: Column, old: dict[str, object], where: str = "true") -> DataFrame:
    """A stored table, in folders by ``part``, after the load of ``fresh``: it held ``stored_side`` and the same rows in the folder
    ``far``, which the batch does not touch."""
    spark = fresh.sparkSession
    fresh = cut_lineage(fresh)
    path = scratch_path(spark, "stored")
    untouched = fresh.filter(where).withColumn(part, F.lit(far).cast(fresh.schema[part].dataType))
    up.replace_partitions(stored_side(fresh, key, other_key, old, where).unionByName(untouched), path, [part])
    up.change_stored(path, fresh, [part], change)
    return spark.read.schema(fresh.schema).parquet(path).select(*fresh.columns)


def loaded_sql(select: str, part: str, far: str, key: str, other_key: str, old: dict[str, str], where: str = "true") -> str:
    return stored_sql("", select, key, other_key, old, where) + f" UNION ALL SELECT * REPLACE ({far} AS {part}) FROM fresh WHERE {where}"
