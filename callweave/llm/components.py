"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from callweave.session import scratch_path


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in ``links`` with columns ``a`` and ``b``.

    Large-star and small-star rounds in turn: every id is linked to the smallest of its neighbours, until only stars are
    left, in about as many rounds as the logarithm of the longest path. Each round reads a written table; the
    links of one id are reduced to their minimum before they are shuffled, and joins on ids with many links are
    split by Spark. Links with nulls and links of an id to itself are left out; repeated links count once.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    spark = links.sparkSession
    path = scratch_path(spark, "stage")
    links.distinct().write.parquet(path)
    # the rounds have a session of their own: one that has observed a write cannot be sent along with tasks any more
    rounds = spark.newSession()
    rounds.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    at = rounds.read.schema(links.schema).parquet(path)
    state = tuple(at.agg(F.count(F.lit(1)), _hash_sum()).first())
    while state[0]:
        path, new = _written(_small_star(_large_star(at)))
        if new == state:
            break
        at, state = rounds.read.schema(links.schema).parquet(path), new
    links = spark.read.schema(links.schema).parquet(path)
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _hash_sum():
    return F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))


def _written(links: DataFrame) -> tuple[str, tuple]:
    """Path of the written links, and their number and the sum of their hashes, gathered while they are written."""
    seen, path = Observation(), scratch_path(links.sparkSession, "stage")
    links.observe(seen, F.count(F.lit(1)).alias("n"), _hash_sum().alias("sum")).write.parquet(path)
    return path, (seen.get["n"], seen.get["sum"])


def _large_star(links: DataFrame) -> DataFrame:
    """Links of each id to larger ids move to the smallest id around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links of each id to smaller ids move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
