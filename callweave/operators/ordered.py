"""Ordered per-key columns (numbering, lag, lead, running values).

A plain window puts all rows of a key into one task, which suits keys with a natural bound: the rows of a conversation,
of a person, of a configured list. ``split`` is for keys without one. Rows are then range-partitioned on (key, order), so that
a hot key spreads over many partitions, numbered inside each partition, and corrected with one carry row per
(key, partition). The caller says which; nothing is counted while a plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.session import cut_lineage

def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` between two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys],
    )


def with_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    row_number: str | None = None,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    running_max: Mapping[str, str] | None = None,
    running_sum: Mapping[str, str] | None = None,
    split: bool = False,
) -> DataFrame:
    """Add ordered columns per key, ascending in ``order`` (nulls first).

    The mappings go from new column to source column. (keys, order) must be unique for results that do not depend on the
    plan. ``split`` spreads the rows of each key over tasks, at the cost of one written table.
    """
    ops = (row_number, lag or {}, lead or {}, running_max or {}, running_sum or {})
    return (_split if split else _plain)(df, list(keys), list(order), *ops)


def _plain(df, keys, order, row_number, lag, lead, running_max, running_sum):
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {}
    if row_number:
        cols[row_number] = F.row_number().over(w).cast("long")
    cols.update({new: F.lag(src).over(w) for new, src in lag.items()})
    cols.update({new: F.lead(src).over(w) for new, src in lead.items()})
    cols.update({new: F.max(src).over(upto) for new, src in running_max.items()})
    cols.update({new: F.sum(src).over(upto) for new, src in running_sum.items()})
    return df.withColumns(cols)


def _split(df, keys, order, row_number, lag, lead, running_max, running_sum):
    # the partition id must not change between the two reads below, hence the written table
    ranged = cut_lineage(
        df.repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id())
    )
    part = [*keys, "_pid"]
    at = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.max_by(src, at).alias(f"_last_{new}") for new, src in lag.items()]
    aggs += [F.min_by(src, at).alias(f"_first_{new}") for new, src in lead.items()]
    aggs += [F.max(src).alias(f"_max_{new}") for new, src in running_max.items()]
    aggs += [F.sum(src).alias(f"_sum_{new}") for new, src in running_sum.items()]
    # one row per (key, partition): a key has at most as many rows here as there are partitions
    pieces = Window.partitionBy(*keys).orderBy("_pid")
    before = pieces.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(*part)
        .agg(*aggs)
        .select(
            *part,
            F.col("_n"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
            *[F.lag(f"_last_{n}").over(pieces).alias(f"_carry_{n}") for n in lag],
            *[F.lead(f"_first_{n}").over(pieces).alias(f"_carry_{n}") for n in lead],
            *[F.max(f"_max_{n}").over(before).alias(f"_carry_{n}") for n in running_max],
            *[F.sum(f"_sum_{n}").over(before).alias(f"_carry_{n}") for n in running_sum],
        )
    )
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {"_rn": F.row_number().over(w).cast("long")}
    local.update({f"_local_{n}": F.lag(s).over(w) for n, s in lag.items()})
    local.update({f"_local_{n}": F.lead(s).over(w) for n, s in lead.items()})
    local.update({f"_local_{n}": F.max(s).over(upto) for n, s in running_max.items()})
    local.update({f"_local_{n}": F.sum(s).over(upto) for n, s in running_sum.items()})
    joined = (
        ranged.withColumns(local)
        .alias("d")
        .join(carry.alias("c"), same_keys("d", "c", part), "inner")
    )

    def mine(name):
        return F.col(f"d._local_{name}")

    def carried(name):
        return F.col(f"c._carry_{name}")

    cols = [F.col(f"d.`{c}`") for c in df.columns]
    if row_number:
        cols.append((F.col("d._rn") + F.col("c._rows_before")).alias(row_number))
    first = F.col("d._rn") == 1
    last = F.col("d._rn") == F.col("c._n")
    cols += [F.when(first, carried(n)).otherwise(mine(n)).alias(n) for n in lag]
    cols += [F.when(last, carried(n)).otherwise(mine(n)).alias(n) for n in lead]
    cols += [F.greatest(mine(n), carried(n)).alias(n) for n in running_max]
    cols += [
        F.when(mine(n).isNull(), carried(n))
        .otherwise(mine(n) + F.coalesce(carried(n), F.lit(0)))
        .alias(n)
        for n in running_sum
    ]
    return joined.select(*cols)


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, split: bool = False) -> DataFrame:
    """``rank()`` with ties, ascending in ``order`` (nulls first). ``split`` spreads the rows of each key over tasks, also rows
    that tie, at the cost of one written table; ``df`` is read once."""
    if not split:
        return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    # rows that tie may go to several partitions, so their number sets no bound on a task
    spread = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys, *order, "_row").drop("_row")
    ranged = cut_lineage(spread.withColumn("_pid", F.spark_partition_id()))
    part = [*keys, "_pid"]
    at = F.struct(*[F.col(f"`{c}`") for c in order])
    local = ranged.withColumn("_rank", F.rank().over(Window.partitionBy(*part).orderBy(*order)))
    # one row per (key, partition): its number of rows, its last value and the rank of that inside the partition
    pieces = local.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), F.max(at).alias("_last"), F.max("_rank").alias("_lastRank"))
    w = Window.partitionBy(*keys).orderBy("_pid")
    pieces = pieces.withColumns({
        "_before": F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_prev": F.lag("_last").over(w),
        "_pieceNo": F.row_number().over(w),
    })
    # a partition whose last value is that of the one before holds nothing else, and passes its rank on
    begun = (F.col("_pieceNo") == 1) | ~F.col("_last").eqNullSafe(F.col("_prev"))
    pieces = pieces.withColumn("_carry", F.when(begun, F.col("_before") + F.col("_lastRank")))
    carried = F.last("_carry", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(*part, "_before", "_prev", "_pieceNo", carried.alias("_carried"))
    joined = local.alias("d").join(pieces.alias("c"), same_keys("d", "c", part))
    ties = (F.col("c._pieceNo") > 1) & F.struct(*[F.col(f"d.`{c}`") for c in order]).eqNullSafe(F.col("c._prev"))
    rank = F.when(ties, F.col("c._carried")).otherwise(F.col("c._before") + F.col("d._rank")).cast("long")
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns], rank.alias(name))


def number_all(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Number every row of the table along ``order`` without a single-partition window."""
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition of the numbered table
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_pid").orderBy(*order)
    return (
        ranged.withColumn("_rn", F.row_number().over(local))
        .join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_rn") + F.col("_off") + F.lit(start - 1))
        .drop("_rn", "_off", "_pid")
    )


def newest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """First row per key in ``order``.

    Written as ``row_number() = 1`` so that Spark keeps one row per key and map task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_n(df: DataFrame, keys: Sequence[str], n: int, *order: Column, name: str = "_rn") -> DataFrame:
    """First ``n`` rows per key, numbered in ``name``; also limited per map task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
