"""Table upserts as DataFrame functions: (target, source, keys) -> new target."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.operators.ordered import newest, same_keys
from callweave.session import cut_lineage


class DuplicateKeys(ValueError):
    """The source of a merge holds a key more than once."""


class BadInterval(ValueError):
    """A batch holds intervals of an unexpected length."""


def _on(keys: Sequence[str], null_safe: bool) -> Column | list[str]:
    return same_keys("t", "s", keys) if null_safe else list(keys)


def without(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``target`` whose key is not in ``source``."""
    found = source.select(*keys).distinct()
    if null_safe:
        return target.alias("t").join(found.alias("s"), same_keys("t", "s", keys), "left_anti")
    return target.join(found, list(keys), "left_anti")


def without_beside(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Like ``without``, null-safe, for sides whose rows were both spread by one of the keys: they are laid side by side and compared
    where they are, without a shuffle."""
    both = target.withColumn("_found", F.lit(False)).unionByName(source.select(*keys, F.lit(True).alias("_found")), allowMissingColumns=True)
    hit = F.bool_or("_found").over(Window.partitionBy(*keys))
    return both.withColumn("_hit", hit).filter("not _hit").select(*target.columns)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice."""
    if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise DuplicateKeys(f"duplicate merge keys in {list(keys)}")


def merge_all(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True, check: bool = True, beside: bool = False
) -> DataFrame:
    """Update all columns on a match, insert otherwise. ``beside`` is for sides that were both spread by one of the keys, see
    ``without_beside``."""
    if check:
        require_unique(source, keys)
    if beside:
        return without_beside(target, source, keys).unionByName(source)
    return without(target, source, keys, null_safe).unionByName(source)


def merge_new(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Insert only the keys that the target does not hold."""
    return target.unionByName(without(source, target, keys, null_safe))


def merge_delete(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the rows whose key is in the source."""
    return without(target, source, keys, null_safe=False)


def replace_matching(target: DataFrame, source: DataFrame, keys: Sequence[str], distinct: bool = False) -> DataFrame:
    """Delete the rows that share a key with the source, then insert the source (or its distinct rows)."""
    kept = without(target, source, keys, null_safe=False)
    return kept.unionByName(source.distinct() if distinct else source)


def merge_newest(target: DataFrame, source: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Merge from a source that holds several versions per key; only the first in ``order`` counts."""
    return merge_all(target, newest(source, keys, *order), keys, check=False)


def rolling_reload(
    target: DataFrame, source: DataFrame, date_col: str, as_of: Column, days: int, months: int
) -> DataFrame:
    """Drop the last ``days`` days, append the reload, return the last ``months`` months."""
    cutoff = F.date_sub(as_of, days)
    kept = target.filter(F.col(date_col).cast("date") < cutoff)
    fresh = source.filter(F.col(date_col).cast("date") >= cutoff)
    return kept.unionByName(fresh).filter(F.col(date_col).cast("date") >= F.add_months(as_of, -months))


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> bool:
    """Overwrite exactly the partitions in the batch; an empty batch changes nothing.

    The rebalance hint brings a partition's rows together, so that it gets few files, and splits a
    partition that is much larger than the others over several tasks.
    """
    if df.isEmpty():
        return False
    (
        df.hint("rebalance", *[F.col(c) for c in partition_cols])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    return True


def commit_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> bool:
    """Like ``replace_partitions`` for a batch derived from the table at ``path`` itself."""
    return replace_partitions(cut_lineage(df), path, partition_cols)


def change_stored(path: str, batch: DataFrame, parts: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Apply ``change(old, batch)`` to the table stored at ``path`` in folders by ``parts``, inside the folders of the batch.

    Only the folders that the batch has rows for are read and written; the files of all others stay as they are. The keys of
    the change must therefore hold ``parts``. A folder without rows afterwards is removed. An empty batch changes nothing, a table
    without files is created. Batch rows need a value for every part.
    """
    spark = batch.sparkSession
    # both sides of the change and the folders come from one computation of the batch
    batch = cut_lineage(batch)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in parts])
    if not batch.filter(missing).isEmpty():
        raise ValueError(f"the batch has rows without {list(parts)}")
    touched = batch.select(*parts).distinct()
    if not path_exists(spark, path):
        replace_partitions(change(batch.limit(0), batch), path, parts)
        return
    # one row a folder; broadcast, it prunes the scan of the stored table
    old = spark.read.schema(batch.schema).parquet(path).join(F.broadcast(touched), list(parts), "left_semi")
    new = cut_lineage(change(old.select(*batch.columns), batch))
    replace_partitions(new, path, parts)
    for row in touched.join(new.select(*parts).distinct(), list(parts), "left_anti").collect():
        drop_folder(spark, path, {c: row[c] for c in parts})


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store."""
    files, where = _file_system(spark, path)
    return files.exists(where)


def drop_folder(spark: SparkSession, path: str, values: dict[str, object]) -> None:
    """Remove the folder of one combination of partition values below ``path``."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    files, where = _file_system(spark, "/".join([path, *[f"{c}={escape(str(v))}" for c, v in values.items()]]))
    files.delete(where, True)


def overwrite_unless_empty(df: DataFrame, path: str) -> bool:
    """Replace the whole table, but keep the old one when the batch is empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def backfill(target: DataFrame, column: str, rules: Sequence[tuple[DataFrame, Sequence[str], str]], when: Column) -> DataFrame:
    """Fill a null ``column`` on rows where ``when`` holds, from lookups tried in priority order.

    A rule is (lookup, key columns, value column); a lookup with several values per key gives its
    smallest.
    """
    names = target.columns
    out = target
    found = []
    for i, (lookup, keys, value) in enumerate(rules):
        one = lookup.groupBy(*keys).agg(F.min(value).alias(f"_v{i}"))
        out = out.join(one, list(keys), "left")
        found.append(F.col(f"_v{i}"))
    filled = F.when(F.col(column).isNull() & when, F.coalesce(*found)).otherwise(F.col(column))
    return out.withColumn(column, filled).select(*names)


def flag_where_exists(target: DataFrame, source: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Set ``flag`` to true on rows with a match; other rows keep their value."""
    names = target.columns
    hit = source.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (
        target.join(hit, list(keys), "left")
        .withColumn(flag, F.coalesce("_hit", F.col(flag)))
        .select(*names)
    )


def update_from_first(
    target: DataFrame, source: DataFrame, keys: Sequence[str], column: str, value: str, order: Column
) -> DataFrame:
    """Set ``column`` to the first non-null ``value`` of the key; unmatched rows keep theirs."""
    names = target.columns
    first = (
        source.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias("_first"))
    )
    return (
        target.join(first, list(keys), "left")
        .withColumn(column, F.coalesce("_first", F.col(column)))
        .select(*names)
    )


def guard_interval(df: DataFrame, start: str, end: str, seconds: int) -> DataFrame:
    """Fail before the write when an interval is not exactly ``seconds`` long."""
    length = F.unix_timestamp(end) - F.unix_timestamp(start)
    if not df.filter(~length.eqNullSafe(F.lit(seconds).cast("long"))).isEmpty():
        raise BadInterval(f"interval [{start}, {end}) is not {seconds} seconds long")
    return df


def register_members(dim: DataFrame, facts: DataFrame, column: str, id_col: str, name_col: str) -> DataFrame:
    """Insert ids that the dimension lacks; the name is the id with blanks for underscores."""
    seen = (
        facts.filter(F.col(column).isNotNull())
        .select(F.col(column).alias(id_col))
        .distinct()
        .withColumn(name_col, F.regexp_replace(id_col, "_", " "))
    )
    return merge_new(dim, seen, [id_col], null_safe=False)


def validity_ranges(df: DataFrame, keys: Sequence[str], start: str, last_seen: str, active: str, default_start: str) -> DataFrame:
    """One membership row per key: open end ``9999-12-31`` while active, else the last day seen."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.min(start), F.to_date(F.lit(default_start))).alias("startDate"),
        F.when(F.bool_or(active), F.to_date(F.lit("9999-12-31"))).otherwise(F.max(last_seen)).alias("endDate"),
    )
