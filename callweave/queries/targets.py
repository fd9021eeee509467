"""Loads of every declared target, from rows delivered as text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.plans import targets
from callweave.queries.registry import query
from callweave.session import scratch_path


def _text(field, i, key):
    """Delivered value of the i-th column: by type out of the row's key, absent for some keys."""
    n = F.col(key) + i
    value = {
        T.LongType(): n.cast("string"),
        T.BooleanType(): F.when(n % 2 == 0, "true").otherwise("false"),
        T.DoubleType(): (n % 50 / 4).cast("string"),
        T.TimestampType(): F.concat(F.lit("2024-01-01T"), F.lpad((n % 24).cast("string"), 2, "0"), F.lit(":30:00Z")),
        T.StringType(): F.concat(F.lit(f"{field.name} "), n % 9),
    }[field.dataType]
    return F.when(n % 11 != 0, value).alias(field.name)


def _sql_value(field, i):
    n = f"(l_partkey + {i})"
    value = {
        T.LongType(): f"{n}::BIGINT",
        T.BooleanType(): f"{n} % 2 = 0",
        T.DoubleType(): f"({n} % 50 / 4)::DOUBLE",
        T.TimestampType(): f"(TIMESTAMP '2024-01-01 00:30:00' + to_hours({n} % 24))::VARCHAR",
        T.StringType(): f"'{field.name} ' || ({n} % 9)",
    }[field.dataType]
    return f'CASE WHEN {n} % 11 <> 0 THEN {value} END AS "{field.name}"'


def _register(name):
    t = targets.target(name)
    fields = list(enumerate(t.schema.fields))
    rows = f"SELECT DISTINCT {', '.join(_sql_value(f, i) for i, f in fields)} FROM lineitem"
    again = f"{rows} WHERE l_linenumber = 2"

    @query(f"{'p1' if t.replaces else 'p2'}_{name}", rows if t.replaces else f"{rows} UNION ALL ({again})")
    def loaded(tables):
        path = scratch_path(tables.spark, f"target-{name}")
        # deliveries come with columns that the target lacks, and not in its order
        delivered = tables.lineitem.select(F.lit("x").alias("unknown"), "l_linenumber", *[_text(f, i, "l_partkey") for i, f in reversed(fields)])
        second = delivered.filter("l_linenumber = 2")
        for part in (second, delivered) if t.replaces else (delivered, second):
            targets.load(part, name, path)
        return tables.spark.read.schema(t.schema).parquet(path)


for _name in (*targets.REPLACED, *targets.APPENDED):
    _register(_name)
