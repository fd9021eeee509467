"""Mixing sources to target weights.

Documents get hash-random keys and are range-sorted by (source, key). Prefix sums of their sizes come from sums
inside each range partition plus the totals of the partitions before it, so a source may be of any size. Each
source is then cut where its running size reaches its budget, after as many whole passes as fit in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.common import documents, identity, word_count
from callweave.llm.registry import query
from callweave.session import cut_lineage


def source_targets(sizes: DataFrame, weights: Column | None = None, max_epochs: int = 3) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of each source out of rows with ``source`` and ``size``.

    Sources in code point order, null last, weigh 1, 2, 3, repeating, unless ``weights`` (a column over
    ``source`` and ``source_no``, positive) says otherwise. The total of all sizes is shared by weight;
    targets stop at ``max_epochs`` times the source's size and the excess goes to the others by weight until
    none is above: the sources whose limit a weight lies lowest stop first, and the rest have one common
    level. The windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = total.withColumn("source_no", F.row_number().over(by_name))
    weight = weights if weights is not None else (F.col("source_no") - 1) % 3 + 1
    total = total.withColumn("w", weight).withColumn("cap", F.col("source_size") * max_epochs)
    ordered = Window.orderBy(F.col("cap") / F.col("w"), "source_no")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = total.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))),
    ).withColumn("full", F.col("cap") / F.col("w") <= F.col("level"))
    rest = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True)
    level = rest.over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return total.withColumn("open_level", level).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(F.col("open_level") * F.col("w"))
        .alias("target"),
    )


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", weights: Column | None = None, max_epochs: int = 3) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``_doc``, ``_row``, ``_copy``, ``source``, ``size``, ``source_size``, ``target``,
    ``epochs`` (how often the mix takes the row) and ``taken`` (its words, repeats counted).

    The size of a row is its number of words, null texts have none. A source takes whole passes over its rows as
    long as they fit in its target, then rows in the order of their random keys up to the one whose end lies
    nearest to what is left; documents are never cut, so a source misses its target by half a document at most. Null is
    a source of its own. Repeated rows and rows without an id are mixed one by one; keys depend on ids, texts and
    ``seed`` alone, so reruns agree. An empty table gives an empty table.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        *identity(id_col, text_col),
        F.col(f"`{source_col}`").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    ).withColumn("key", F.md5(F.concat("_doc", F.lit(f" {seed}"))))
    keyed = (
        rows.repartitionByRange(F.col("source").asc_nulls_last(), "key", "_doc", "_row")
        .withColumn("part", F.spark_partition_id())
        .transform(cut_lineage)
    )
    # rows of one (partition, source) are at most one range partition
    inside = Window.partitionBy("part", "source").orderBy("key", "_doc", "_row").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        keyed.groupBy("part", "source")
        .agg(F.sum("size").alias("part_size"))
        .withColumn("before", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    )
    targets = source_targets(parts.select("source", F.col("part_size").alias("size")), weights, max_epochs)
    offsets = parts.alias("p").join(targets.alias("t"), F.expr("p.source <=> t.source")).select("p.part", "p.source", "p.before", "t.source_size", "t.target")
    cut = (
        keyed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .alias("k")
        .join(offsets.alias("o"), F.expr("k.part = o.part AND k.source <=> o.source"))
        .select("k.id", "k._doc", "k._row", "k.source", "k.size", "o.source_size", "o.target", (F.col("k.within") + F.col("o.before")).alias("start"))
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    last = (F.col("size") > 0) & (2 * F.col("start") + F.col("size") <= 2 * rest)
    cut = cut.withColumn("passes", F.least(passes, F.lit(max_epochs)))
    cut = cut.withColumn("epochs", (F.col("passes") + F.when(last, 1).otherwise(0)).cast("long"))
    copy = F.row_number().over(Window.partitionBy("_doc", "_row").orderBy("source", "epochs"))
    return cut.select(
        F.col("id").alias(id_col), "_doc", "_row", copy.alias("_copy"), "source", "size", "source_size", "target", "epochs",
        (F.col("size") * F.col("epochs")).alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as :func:`mixture` takes it, with its columns unchanged."""
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_columns")
    same = Window.partitionBy("_doc", "_row").orderBy(F.col(f"_columns.`{source_col}`"))
    rows = docs.select(columns, *identity(id_col, text_col)).withColumn("_copy", F.row_number().over(same))
    taken = mixture(docs, id_col, text_col, source_col, **options).filter("epochs > 0").select("_doc", "_row", "_copy", F.col("epochs").cast("int").alias("_epochs"))
    again = rows.join(taken, ["_doc", "_row", "_copy"]).withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_epochs"))))
    return again.select("_columns.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(doc_id::VARCHAR || ' mix') AS key FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), n AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, source_size * 3 AS cap,
    row_number() OVER (ORDER BY source NULLS LAST) AS no FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0))::DOUBLE
    / (sum(w) OVER () - coalesce(sum(w) OVER p, 0))::DOUBLE AS level FROM n
  WINDOW p AS (ORDER BY cap::DOUBLE / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), o AS (
  SELECT arg_min(level, no2) AS open_level FROM (
    SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, no) AS no2 FROM l) WHERE cap::DOUBLE / w > level
), t AS (
  SELECT source, source_size, CASE WHEN cap::DOUBLE / w <= level THEN cap::DOUBLE ELSE open_level * w END AS target
  FROM l, o
), c AS (
  SELECT d.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS passes
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (passes + CASE WHEN size > 0
  AND 2 * start + size <= 2 * (target - passes * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""


@query("op4_mixing", SQL)
def op4_mixing(spark, folder):
    """What a mix of all documents takes of each."""
    return mixture(documents(spark, folder).select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")
