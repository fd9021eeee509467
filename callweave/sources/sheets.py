"""Delivered sheets: text files whose rows mean something by their position (a date line, a header line, a total that ends them)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def positioned_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``position`` (from 1, in file order) and ``line`` of all text files below ``path``.

    A large file is read in splits by several tasks. Lines are numbered inside each split and moved by the number of lines of the
    splits before it, so no task sorts a whole file.
    """
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line")
    )
    # one row a split
    sizes = read.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("file", "_block").orderBy("_at"))
    numbered = read.withColumn("_at", F.monotonically_increasing_id()).withColumn("_own", own)
    return numbered.join(offsets, ["file", "_block"]).select("file", (F.col("_before") + F.col("_own")).alias("position"), "line")


def cells(line: Column, width: int) -> Column:
    """Cells of a comma-separated line, quotes taken off; ``width`` of them, null where the line is shorter or a cell is empty."""
    names = [f"c{i}" for i in range(width)]
    row = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE"})
    return F.array(*[F.nullif(F.trim(row[n]), F.lit("")) for n in names])


def table(lines: DataFrame, columns: Mapping[str, str], header_at: int, width: int = 64, total: str | None = None, total_in: str | None = None) -> DataFrame:
    """``file``, ``position`` and ``columns`` (new name to header text) of the rows below the header line of each file.

    Columns are found by the header's texts, so files may order them differently; a file without one has nulls there. The first
    row whose ``total_in`` column is ``total`` ends the table: it and all rows after it are left out, and so are files without a
    header line.
    """
    split = lines.filter(F.col("position") >= header_at).select("file", "position", cells(F.col("line"), width).alias("_cells"))
    header = split.filter(F.col("position") == header_at).select("file", F.col("_cells").alias("_header"))
    rows = split.filter(F.col("position") > header_at).join(header, "file")
    at = {n: F.coalesce(F.array_position("_header", F.lit(h.strip())), F.lit(0)) for n, h in columns.items()}
    out = rows.select("file", "position", *[F.when(a > 0, F.get("_cells", (a - 1).cast("int"))).alias(n) for n, a in at.items()])
    if total is None:
        return out
    ends = out.filter(F.col(total_in) == total).groupBy("file").agg(F.min("position").alias("_end"))
    return out.join(ends, "file", "left").filter(F.col("_end").isNull() | (F.col("position") < F.col("_end"))).drop("_end")
