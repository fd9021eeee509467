"""Words, identities and prefix sums shared by the operators for training data."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; everything between it is a word.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when the body uses it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACE[1:], " " * (len(SPACE) - 1))
    return F.array_remove(F.split(plain, " "), "")


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def identity(id_col: str, text_col: str) -> list[Column]:
    """Columns ``_doc`` and ``_row``: the document a row belongs to, and the row itself.

    Rows of one id are one document; rows without an id are told apart by their text.
    """
    text = F.xxhash64(F.col(f"`{text_col}`"), F.col(f"`{text_col}`").isNull())
    doc = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit("null "), text.cast("string")))
    return [doc.alias("_doc"), text.alias("_row")]


def documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that what is made of one stays small beside it."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps. Spark drops them when neither Python nor the driver's JVM refers to
    the step any more, which both find out only when they collect garbage. Python tells the JVM from a thread of its own, so
    the second round finds what the first one let go."""
    for _ in range(2):
        gc.collect()
        time.sleep(1)
        spark.sparkContext._jvm.System.gc()
