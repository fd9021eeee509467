"""Run a registered query on Spark and its SQL on DuckDB and compare rows, names and types."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from callweave.sources.tables import TABLES

KIND = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "double": "double", "float": "float",
    "string": "text", "boolean": "bool", "BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16",
    "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "text", "BOOLEAN": "bool",
}


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def compare(spark, con, folder, q):
    """List of differences; empty when both sides agree."""
    df = q(spark, folder)
    rel = con.sql(q.sql)
    names = sorted(df.columns)
    problems = []
    if names != sorted(rel.columns):
        return [f"columns {names} != {sorted(rel.columns)}"], 0
    left = {c: KIND.get(t, t) for c, t in df.dtypes}
    right = {c: KIND.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    problems += [f"type of {c}: {left[c]} != {right[c]}" for c in names if left[c] != right[c]]
    a = Counter(tuple(r[c] for c in names) for r in df.collect())
    order = [rel.columns.index(c) for c in names]
    b = Counter(tuple(r[i] for i in order) for r in rel.fetchall())
    if a != b:
        extra, missing = list((a - b).items()), list((b - a).items())
        rough = Counter({_rough(k): v for k, v in a.items()}) == Counter({_rough(k): v for k, v in b.items()})
        problems.append(
            f"rows {sum(a.values())} vs {sum(b.values())}; only in Spark {len(extra)}, only in SQL {len(missing)}"
            f"{' (float noise only)' if rough else ''}\n   {names}\n   S {sorted(extra, key=str)[:3]}\n   D {sorted(missing, key=str)[:3]}"
        )
    return problems, sum(a.values())


def _rough(row):
    return tuple(
        float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else v for v in row
    )
