"""Reading landed files into typed rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: field and row marks of the delimited dump
FIELD_MARK = "<EOFD>"
ROW_MARK = "<EORD>"


def read_json(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Nested JSON lines with a declared schema; a malformed record fails the job when ``strict``."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(schema).option("mode", mode).json(path)


def dedup_rows(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Exact-row dedup, switchable per endpoint."""
    return df.dropDuplicates() if enabled else df


def partition_key(extract_date: str | Column, start: str | Column, end: str | Column) -> Column:
    """Lineage stamp ``extractDate|start|end``."""
    return F.concat_ws("|", extract_date, start, end)


def add_lineage(
    df: DataFrame,
    extract_date: str,
    start: str,
    end: str,
    insert_time: Column | None = None,
    record_id: Column | None = None,
) -> DataFrame:
    """Stamp the extract window, the insert time and a record id on every row."""
    return df.withColumns(
        {
            "extractDate": F.to_date(F.lit(extract_date)),
            "extractIntervalStartTime": F.to_timestamp(F.lit(start)),
            "extractIntervalEndTime": F.to_timestamp(F.lit(end)),
            "recordInsertTime": insert_time if insert_time is not None else F.current_timestamp(),
            "recordIdentifier": record_id if record_id is not None else F.monotonically_increasing_id(),
        }
    )


def pick_up_json(spark: SparkSession, path: str, schema: T.StructType, insert_time: Column) -> DataFrame:
    """Newly landed device files: typed, deduplicated, stamped, ready to append."""
    df = dedup_rows(read_json(spark, path, schema))
    return df.withColumn("recordInsertTime", insert_time)


def read_delimited_dump(
    spark: SparkSession, path: str, file_columns: Sequence[str], target: T.StructType, encoding: str = "UTF-16LE"
) -> DataFrame:
    """Dump with its own field and row marks; fields may hold newlines.

    ``file_columns`` is the order in the file; the result has the target's columns, absent ones null.
    The text source splits on the encoded row mark and hands over the bytes, which are decoded here.
    """
    lines = spark.read.option("lineSep", ROW_MARK).option("encoding", encoding).text(path)
    text = F.decode(F.col("value").cast("binary"), encoding)
    body = F.regexp_replace(text, "^[\\r\\n\\uFEFF]+", "")
    rows = lines.select(body.alias("_body")).filter(F.length("_body") > 0)
    parts = rows.select(F.split("_body", FIELD_MARK).alias("_parts"))
    position = {name: i for i, name in enumerate(file_columns)}
    cols = []
    for field in target.fields:
        if field.name in position:
            cell = F.nullif(F.get("_parts", F.lit(position[field.name])), F.lit(""))
        else:
            cell = F.lit(None)
        cols.append(cell.cast(field.dataType).alias(field.name))
    return parts.select(*cols)


def load_dump(df: DataFrame, path: str, kind: str) -> None:
    """A FULL dump replaces the table, any other kind is appended."""
    df.write.mode("overwrite" if kind.upper() == "FULL" else "append").parquet(path)


def clean_name(name: str) -> str:
    """Header text to a column name: invalid characters become ``_``, trailing ``_`` go."""
    return re.sub(r"[^0-9A-Za-z_]", "_", name.strip()).rstrip("_")


def read_csv_clean(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose names are cleaned."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.toDF(*[clean_name(c) for c in df.columns])


def read_csv_payload(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV payload as text columns with blanks for nulls."""
    df = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.na.fill("")


def matrix_to_rows(df: DataFrame, rows: str, names: Sequence[str]) -> DataFrame:
    """Config matrix (array of string arrays, first row the header) to a table with ``names``."""
    body = df.select(F.element_at(rows, 1).alias("_head"), F.posexplode(rows).alias("_pos", "_row"))
    cells = [
        F.get(F.col("_row"), (F.array_position("_head", n) - 1).cast("int")).alias(n) for n in names
    ]
    return body.filter("_pos > 0").select(*cells)


def split_cells(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row per line of a multi-line cell."""
    return df.withColumn(out, F.explode(F.split(column, "\n")))


def pack_struct(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Move flat columns into an array holding one struct."""
    return df.withColumn(name, F.array(F.struct(*columns))).drop(*columns)


def unpack_envelope(df: DataFrame, entity: str) -> DataFrame:
    """Landed envelopes back to rows: one per element of the entity array."""
    return df.select(F.explode(entity).alias("_e")).select("_e.*")


def ledger_has(ledger: DataFrame, endpoint: str, extract_date: str, start: str, end: str) -> bool:
    """Was this endpoint already loaded for the window?"""
    hit = ledger.filter(
        (F.col("endpoint") == endpoint)
        & (F.col("extractDate") == F.to_date(F.lit(extract_date)))
        & (F.col("extractIntervalStartTime") == F.to_timestamp(F.lit(start)))
        & (F.col("extractIntervalEndTime") == F.to_timestamp(F.lit(end)))
    )
    return not hit.isEmpty()


def newest_run(ledger: DataFrame, *keys: str) -> DataFrame:
    """Latest ledger row per endpoint and date, by load time."""
    from callweave.operators.ordered import newest

    return newest(ledger, keys, F.col("loadTime").desc(), F.col("recordCount").desc())


def flatten_issue(df: DataFrame) -> DataFrame:
    """Issue documents to columns; the "market brand" cell comes from either of two custom fields."""
    cell = F.coalesce("fields.market_brand", "fields.market_brand_alt")
    words = F.split(cell, " ", 2)
    return df.select(
        F.col("id").alias("issueId"),
        F.col("key").alias("issueKey"),
        F.col("fields.project.key").alias("projectKey"),
        F.col("fields.priority.name").alias("priority"),
        F.col("fields.status.name").alias("status"),
        F.col("fields.assignee.displayName").alias("assigneeName"),
        F.get(words, 0).alias("market"),
        F.get(words, 1).alias("brand"),
        F.to_timestamp("fields.created").alias("createdDate"),
        F.to_timestamp("fields.resolutiondate").alias("resolutionDate"),
    )
