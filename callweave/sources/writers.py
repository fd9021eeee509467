"""Writing result tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators.ordered import number_all

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


def write_sized(df: DataFrame, path: str, max_per_file: int = 5_000_000) -> None:
    """Parquet files of ``max_per_file`` rows at most; tasks start a new file when one is full. Landed rows repeat their ids in
    many columns, which zstd packs to half of what snappy does."""
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", max_per_file).parquet(path)


def in_splits(df: DataFrame) -> bool:
    """Whether ``df`` comes in as many splits as the session has cores; planning alone tells."""
    return df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out to as many tasks as the session has cores where it comes in fewer splits.

    Rows are dealt by the hash of all their plain columns, as dealing them in turn would sort every task's rows first. For rows that
    come from a scan without a shuffle, whose splits are known before anything runs; to be called before rows are made wide.
    """
    if in_splits(df):
        return df
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *plain)


def land_balanced(df: DataFrame, path: str, max_per_file: int = 5_000_000) -> None:
    """Parquet files for many readers: at least as many as the session has cores, none of more than ``max_per_file`` rows.

    Only a source that comes in fewer splits than there are cores is dealt out anew; what has more splits is written as it is.
    """
    write_sized(spread(df), path, max_per_file)


def write_csv_snapshot(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV snapshot, replaced on each run. ``single_file`` is for dimensions only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_parquet_snapshot(df: DataFrame, path: str, slice_col: str | None = None) -> None:
    """Parquet snapshot, replaced on each run; one folder per region slice when ``slice_col`` is given."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(slice_col) if slice_col else writer).parquet(path)


def batch_numbers(df: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """Slices of ``size`` rows along ``order``, numbered from 1."""
    numbered = number_all(df, order, "_row")
    return numbered.withColumn(name, F.ceil(F.col("_row") / size).cast("int")).drop("_row")


def write_batches(df: DataFrame, path: str, order: Sequence[str], size: int) -> None:
    """Numbered-batch export: all slices in one write, a folder each."""
    batch_numbers(df, order, size).write.mode("overwrite").options(**CSV_OPTIONS).partitionBy("batch").csv(path)


def assign_cyclic(df: DataFrame, order: Sequence[str], workers: Sequence[str], name: str = "worker") -> DataFrame:
    """Row k gets worker k mod n."""
    numbered = number_all(df, order, "_row")
    slots = F.array(*[F.lit(w) for w in workers])
    index = ((F.col("_row") - 1) % len(workers) + 1).cast("int")
    return numbered.withColumn(name, F.element_at(slots, index)).drop("_row")


def shares(df: DataFrame, n: int, *keys: str) -> Column:
    """Share 0..n-1 of a row by the hash of its key; the same row always lands in the same share."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def write_window_export(df: DataFrame, path: str, time_col: str, start: str, end: str) -> None:
    """Half-open window of a fact as CSV files."""
    t = F.col(time_col)
    rows = df.filter((t >= F.to_timestamp(F.lit(start))) & (t < F.to_timestamp(F.lit(end))))
    write_csv_snapshot(rows, path)
