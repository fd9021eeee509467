"""Marks of keys: bits by the hash of a key, of a bounded number, that tell which rows need not meet the other side of a join.

A row whose key is not marked has no match, so it is known without a shuffle; a marked row may have one and is still joined. Rows
are the same whatever the number of bits: with too few for the keys more rows are marked, at worst all of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits at least and at most (16 MB, held by the tasks of a stage), and bits for each row that Spark expects of packed files.
LEAST, MOST, A_ROW = 1 << 16, 1 << 27, 16
_BLOCK = 1 << 10


def _expected_rows(rows: DataFrame) -> int:
    """By Spark's estimate of the bytes, which is known when the plan is; nothing is run."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size // 28 + 1


def hash_of(*keys: str | Column) -> Column:
    return F.xxhash64(*keys)


def marked(hashes: DataFrame, expected: DataFrame | None = None):
    """A condition on hashes of keys: whether one may be among ``hashes`` (one column of longs). The bits follow from the size of
    ``expected`` or of the hashes themselves."""
    rows = _expected_rows(hashes if expected is None else expected)
    bits = min(MOST, max(LEAST, 1 << math.ceil(math.log2(A_ROW * rows))))
    word, bit = F.shiftright("_at", 6).alias("word"), F.expr("shiftleft(1L, cast(_at & 63 AS int))")
    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits)).alias("_at")
    words = hashes.select(at).groupBy(word).agg(F.bit_or(bit).alias("v"))
    none = hashes.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("v"))
    # blocks of words, each in order, then the blocks in order
    every = words.unionByName(none).groupBy(F.floor(F.col("word") / _BLOCK).alias("block"), "word").agg(F.bit_or("v").alias("v"))
    blocks = every.groupBy("block").agg(_in_order("word", "v").alias("v"))
    all_bits = blocks.agg(F.flatten(_in_order("block", "v"))).scalar()

    def may_hold(key: Column) -> Column:
        place = F.pmod(key, F.lit(bits))
        return F.getbit(F.get(all_bits, F.shiftright(place, 6).cast("int")), (place.bitwiseAND(F.lit(63))).cast("int")) == 1

    return may_hold


def _in_order(number: str, value: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(number, value))), lambda x: x[value])


def possible(table: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``table`` whose keys may be in ``wanted``: all that are and some others. Keys have the same types on both sides."""
    hashes = wanted.select(hash_of(*keys).alias("_hash"))
    return table.filter(marked(hashes, wanted.select(*keys))(hash_of(*keys)))
