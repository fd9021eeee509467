"""Live boards and landing streams as Structured Streaming jobs.

Every job states its lateness bound as a watermark. Sinks are safe to replay: a micro-batch that is run
again writes the same partitions again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators import upserts as up
from callweave.operators.ordered import newest

BUCKETS = 64


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of landed JSON files; a malformed record fails the stream."""
    return (
        spark.readStream.schema(schema)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )


def device_events(stream: DataFrame, at: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """Device events without repeated deliveries: a key seen within the lateness bound counts once."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(list(keys))


def interval_metrics(
    stream: DataFrame, at: str, keys: Sequence[str], name: str, value: str, names: Sequence[str], lateness: str, width: str = "15 minutes"
) -> DataFrame:
    """Tumbling metrics: the sum and, as ``<metric>Count``, the number of values of each metric of a fixed list, 0 where a
    metric is missing. In update mode open windows come out as they stand; rows later than ``lateness`` are dropped."""
    mine = {n: F.when(F.col(name) == n, F.col(value)) for n in names}
    cells = [F.coalesce(F.sum(v), F.lit(0).cast("long")).alias(n) for n, v in mine.items()]
    cells += [F.count(v).alias(f"{n}Count") for n, v in mine.items()]
    out = stream.withWatermark(at, lateness).groupBy(F.window(at, width), *keys).agg(*cells)
    columns = [*names, *[f"{n}Count" for n in names]]
    return out.select(F.col("window.start").alias("intervalStart"), F.col("window.end").alias("intervalEnd"), *keys, *columns)


def latest_local_day(table: DataFrame, at: str, zones: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the newest local day of each time zone; ``zones`` has ``keys`` and ``timeZone``. Rows without a zone are left out."""
    local = table.join(zones.select(*keys, "timeZone"), list(keys))
    local = local.withColumn("_day", F.to_date(F.from_utc_timestamp(at, F.col("timeZone"))))
    last = local.groupBy("timeZone").agg(F.max("_day").alias("_day"))
    return local.join(last, ["timeZone", "_day"], "left_semi").select(*table.columns, "timeZone")


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything that has landed, batch by batch, then stop."""
    q = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    q.awaitTermination()


def append_once(path: str, partition_cols: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Sink that appends each micro-batch exactly once: a replay overwrites the folder of its batch id."""
    def sink(df: DataFrame, batch_id: int) -> None:
        up.replace_partitions(df.withColumn("batchId", F.lit(batch_id)), path, ["batchId", *partition_cols])

    return sink


def upsert_newest(path: str, keys: Sequence[str], order: Column, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the newest row per key. Only the hash buckets of the micro-batch are rewritten.

    Merging a batch twice changes nothing, so a replay is harmless.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        fresh = newest(df, keys, order).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        fresh = fresh.persist()
        try:
            if fresh.isEmpty():
                return
            if _exists(spark, path):
                touched = fresh.select("bucket").distinct()
                old = spark.read.schema(fresh.schema).parquet(path).join(F.broadcast(touched), "bucket", "left_semi")
                merged = newest(old.select(*fresh.columns).unionByName(fresh), keys, order)
                up.commit_partitions(merged, path, ["bucket"])
            else:
                up.replace_partitions(fresh, path, ["bucket"])
        finally:
            fresh.unpersist()

    return sink


def current_board(state_sink: Callable[[DataFrame, int], None], state: str, path: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Sink that brings the stored state up to date and then shows it: the board counts what holds now, so cells also go
    down. Each batch writes a board of its own below ``path``, readers take the newest; a replay writes the same one."""
    def sink(df: DataFrame, batch_id: int) -> None:
        state_sink(df, batch_id)
        board = shape(df.sparkSession.read.parquet(state))
        board.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return sink


def newest_board(spark: SparkSession, path: str) -> DataFrame:
    """The board of the last batch."""
    boards = spark.read.parquet(path)
    return boards.filter(F.col("batch") == boards.agg(F.max("batch")).scalar()).drop("batch")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).limit(1).isEmpty()
    except Exception as e:  # a first batch finds no table yet
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def queue_counts(stream: DataFrame, queue: str, cells: dict[str, Column]) -> DataFrame:
    """Counts per queue for every cell of the board."""
    return stream.groupBy(queue).agg(*[F.count_if(c).alias(n) for n, c in cells.items()])


def full_board(queues: DataFrame, queue: str, cells: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Board with a row for every known queue; cells without events show 0."""
    def shape(counts: DataFrame) -> DataFrame:
        zero = F.lit(0).cast("long")
        return queues.select(queue).distinct().join(counts, queue, "left").select(queue, *[F.coalesce(c, zero).alias(c) for c in cells])

    return shape


def extract_windows(path: str, keys: Sequence[str], window_cols: Sequence[str] = ("extractDate", "extractIntervalStartTime")) -> Callable[[DataFrame, int], None]:
    """Sink for extract windows: rows are merged by key into the partitions of their window.

    Only the partitions of the micro-batch are rewritten. A window may arrive over several
    micro-batches, or again; rows delivered before are replaced, others stay.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        fresh = df.dropDuplicates([*window_cols, *keys]).persist()
        try:
            if _exists(spark, path):
                old = spark.read.schema(fresh.schema).parquet(path)
                touched = fresh.select(*window_cols).distinct()
                old = old.join(touched, list(window_cols), "left_semi").select(*fresh.columns)
                up.commit_partitions(up.merge_all(old, fresh, [*window_cols, *keys], null_safe=False, check=False), path, window_cols)
            else:
                up.replace_partitions(fresh, path, window_cols)
        finally:
            fresh.unpersist()

    return sink
