"""Keyed state of live boards: what an agent does now, and the windows of a queue's newest local day.

Both are state operators with one state for each key, kept in Spark's RocksDB state store, so a micro-batch touches only the keys
that it has rows for. They emit changes; the sinks below bring small tables up to date with them and may be run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from callweave.operators import upserts as up
from callweave.streaming import boards

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """State operators need this store; a running query keeps the one it was started with."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def _fields(schema: T.StructType, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, schema[n].dataType) for n in names]


def _plain(value, field: T.StructField):
    """A cell of a pandas frame as the state store takes it; whole numbers beside nulls come as floats."""
    if pd.isna(value):
        return None
    return int(value) if isinstance(field.dataType, T.IntegralType) else getattr(value, "item", lambda: value)()


class _Now(StatefulProcessor):
    """Newest row of a key. When a newer one comes, the old facts go out with sign -1 and the new ones with +1."""

    def __init__(self, key: str, order: Sequence[str], facts: Sequence[str], state: T.StructType):
        self.key, self.order, self.facts, self.schema = key, list(order), list(facts), state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        best = before = tuple(self.last.get()) if self.last.exists() else None
        for frame in rows:
            row = frame.sort_values(self.order).iloc[-1]
            found = tuple(_plain(row[f.name], f) for f in self.schema)
            if best is None or found[: len(self.order)] > best[: len(self.order)]:
                best = found
        if best != before:
            self.last.update(best)
            changes = [(row[len(self.order) :], sign) for row, sign in ((before, -1), (best, 1)) if row is not None]
            if len(changes) < 2 or changes[0][0] != changes[1][0]:
                yield pd.DataFrame([[key[0], *facts, sign] for facts, sign in changes], columns=[self.key, *self.facts, "sign"])

    def close(self) -> None:
        pass


def changes_of_state(stream: DataFrame, key: str, order: Sequence[str], facts: Sequence[str]) -> DataFrame:
    """``key``, ``facts`` and ``sign``: what each key has stopped being (-1) and what it is now (1), by its newest row.

    ``order`` are columns of whole numbers, the first one most significant; rows of equal order are the same row, and rows
    with a null there are left out. Late rows change nothing, whenever they come.
    """
    rows = stream.select(key, *order, *facts).dropna(subset=list(order))
    schema = rows.schema
    state = T.StructType(_fields(schema, [*order, *facts]))
    out = T.StructType([*_fields(schema, [key, *facts]), T.StructField("sign", T.LongType())])
    return rows.groupBy(key).transformWithStateInPandas(_Now(key, order, facts, state), out, "Update", "none")


def counted_board(path: str, queue: str, cells: dict[str, Column]) -> Callable[[DataFrame, int], None]:
    """Sink for ``changes_of_state``: the board of a batch is that of the batch before plus the batch's changes.

    Cells go up and down. A board has one row a queue; each batch writes one of its own, so that a batch that runs again starts
    from the same one. Only the last two are kept.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        zero = F.lit(0).cast("long")
        sums = [F.coalesce(F.sum(F.when(c, F.col("sign"))), zero).alias(n) for n, c in cells.items()]
        board = df.filter(F.col(queue).isNotNull()).groupBy(queue).agg(*sums)
        if up.path_exists(spark, f"{path}/batch={batch_id - 1}"):
            board = board.unionByName(spark.read.schema(board.schema).parquet(f"{path}/batch={batch_id - 1}"))
            board = board.groupBy(queue).agg(*[F.sum(n).alias(n) for n in cells])
        board.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        up.drop_folder(spark, path, {"batch": batch_id - 2})

    return sink


class _Day(StatefulProcessor):
    """Sums of the windows of a key's newest day; older windows go when a newer day comes."""

    def __init__(self, keys: Sequence[str], cells: T.StructType, value: str):
        self.keys, self.schema, self.value = list(keys), cells, value
        self.names = [f.name for f in cells]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.day = handle.getValueState("day", "day int")
        self.cells = handle.getMapState("cells", self.schema, "total long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        day = self.day.get()[0] if self.day.exists() else None
        touched = set()
        for frame in rows:
            newest = int(frame["localDay"].max())
            if day is None or newest > day:
                day, touched = newest, set()
                self.day.update((day,))
                self.cells.clear()
            sums = frame[frame["localDay"] == day].groupby(self.names, dropna=False)[self.value].sum()
            for at, total in sums.items():
                at = tuple(map(_plain, at if isinstance(at, tuple) else (at,), self.schema))
                before = self.cells.getValue(at)[0] if self.cells.containsKey(at) else 0
                self.cells.updateValue(at, (before + int(total),))
                touched.add(at)
        if touched:
            rows_ = [[*key, day, *at, self.cells.getValue(at)[0]] for at in sorted(touched, key=str)]
            yield pd.DataFrame(rows_, columns=[*self.keys, "localDay", *self.names, "total"])

    def close(self) -> None:
        pass


def newest_day_windows(stream: DataFrame, at: str, zones: DataFrame, queue: str, keys: Sequence[str], value: str, width: str = "15 minutes") -> DataFrame:
    """``intervalStart``, ``queue``, ``keys``, ``total``, ``timeZone`` and ``day``: the windows of each queue's newest local day
    that a micro-batch has changed, with their sums so far. ``zones`` has ``queue`` and ``timeZone``; rows of other queues and
    rows without a time are left out. Rows of an older day than the queue has reached are late and change nothing."""
    local = stream.join(zones.select(queue, "timeZone"), queue).filter(F.col(at).isNotNull())
    start = F.unix_micros(F.window(F.col(at), width)["start"])
    rows = local.withColumn("intervalStart", start).select(
        queue, "timeZone", F.unix_date(F.to_date(F.from_utc_timestamp(F.timestamp_micros("intervalStart"), F.col("timeZone")))).alias("localDay"),
        "intervalStart", *keys, F.coalesce(F.col(value), F.lit(0)).cast("long").alias("amount"),
    )
    cells = T.StructType(_fields(rows.schema, ["intervalStart", *keys]))
    out = T.StructType([*_fields(rows.schema, [queue, "timeZone", "localDay"]), *cells.fields, T.StructField("total", T.LongType())])
    found = rows.groupBy(queue, "timeZone").transformWithStateInPandas(_Day([queue, "timeZone"], cells, "amount"), out, "Update", "none")
    return found.select(
        F.timestamp_micros("intervalStart").alias("intervalStart"), queue, *keys, "total", "timeZone", F.date_from_unix_date("localDay").alias("day")
    )


def newest_day_board(path: str, queue: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Sink for ``newest_day_windows``: windows are replaced by key in the folder of their day, and the folders of days that no
    zone shows any more are removed."""
    windows = boards.extract_windows(path, ["intervalStart", queue, *keys], ["day"])

    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        windows(df, batch_id)
        if not up.path_exists(spark, path):
            return
        table = spark.read.schema(df.schema).parquet(path)
        # a row for each zone, and one for each day
        oldest = table.groupBy("timeZone").agg(F.max("day").alias("day")).agg(F.min("day")).first()[0]
        for row in table.select("day").distinct().filter(F.col("day") < F.lit(oldest)).collect():
            up.drop_folder(spark, path, {"day": row["day"]})

    return sink


def newest_days(board: DataFrame) -> DataFrame:
    """The board's windows of the newest local day of each time zone."""
    newest = board.groupBy("timeZone").agg(F.max("day").alias("day"))
    return board.join(newest, ["timeZone", "day"], "left_semi")
