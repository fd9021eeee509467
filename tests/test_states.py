"""State operators of the live boards against the batch result after every delivery."""

import json
import os
import random

from conftest import rows
from pyspark.sql import functions as F

from callweave.operators.ordered import newest
from callweave.session import scratch_path
from callweave.streaming import boards, states

SCHEMA = "id long, user string, queue string, status string, media string, at timestamp, v long"
NAMES = ["id", "user", "queue", "status", "media", "at", "v"]


def deliveries(seed, n=5, size=40):
    """Rows out of order, with ties in time, repeated rows, and nulls."""
    rng = random.Random(seed)
    made, number = [], 0
    for d in range(n):
        part = []
        for _ in range(size):
            number += 1
            hour, minute = divmod(rng.randrange(0, 36 * 60) + d * 300, 60)
            at = f"2024-01-{1 + hour // 24:02} {hour % 24:02}:{minute // 10 * 10:02}:00"
            part.append((number, f"u{rng.randrange(9)}", rng.choice(["a", "b", "c", None]), rng.choice(["idle", "busy", None]), rng.choice(["voice", "chat"]), rng.choice([at] * 9 + [None]), rng.choice([1, 2, None])))
        made.append(part + part[:3])
    return made


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(NAMES, r, strict=True))) for r in records))


def cells():
    return {"idle": F.col("status") == "idle", "busy_voice": (F.col("status") == "busy") & (F.col("media") == "voice")}


def test_board_equals_the_batch_after_each_delivery(spark, tmp_path):
    src, out, ck = tmp_path / "in", scratch_path(spark, "board"), scratch_path(spark, "ck")
    seen, shown = [], []
    for n, part in enumerate(deliveries(1)):
        land(src, f"{n}.json", part)
        seen += part
        stream = boards.read_files(spark, str(src), spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
        stream = stream.withColumn("micros", F.unix_micros("at"))
        with states.rocks_state(spark):
            changes = states.changes_of_state(stream, "user", ["micros", "id"], ["queue", "status", "media"])
            boards.run_available(changes, ck, states.counted_board(out, "queue", cells()), mode="update")
        table = spark.createDataFrame(seen, SCHEMA.replace("at timestamp", "at string")).withColumn("at", F.to_timestamp("at"))
        now = newest(table.filter("at IS NOT NULL"), ["user"], F.desc("at"), F.desc("id"))
        want = {r[0]: tuple(r)[1:] for r in boards.queue_counts(now.filter("queue IS NOT NULL"), "queue", cells()).collect()}
        got = {r[0]: tuple(r)[1:] for r in boards.newest_board(spark, out).collect()}
        assert {q: c for q, c in got.items() if any(c)} == {q: c for q, c in want.items() if any(c)}
        shown.append(got)
    # some cell went down, and old boards are gone
    assert any(b[q][i] < a.get(q, (0, 0))[i] for a, b in zip(shown, shown[1:]) for q in b for i in (0, 1))
    assert len([d for d in os.listdir(out.removeprefix("file://")) if d.startswith("batch=")]) == 2


def test_a_batch_that_runs_again_gives_the_same_board(spark):
    out = scratch_path(spark, "board")
    sink = states.counted_board(out, "queue", cells())
    schema = "user string, queue string, status string, media string, sign long"
    sink(spark.createDataFrame([("u", "a", "idle", "voice", 1), ("w", "a", "idle", "chat", 1), ("x", None, "idle", "chat", 1)], schema), 0)
    for _ in range(2):
        sink(spark.createDataFrame([("u", "a", "idle", "voice", -1), ("u", "b", "busy", "voice", 1)], schema), 1)
    assert rows(boards.newest_board(spark, out)) == [("a", 1, 0), ("b", 0, 1)]


def test_newest_local_days_equal_the_batch_after_each_delivery(spark, tmp_path):
    src, out, ck = tmp_path / "days", scratch_path(spark, "days"), scratch_path(spark, "ck")
    zones = spark.createDataFrame([("a", "Australia/Sydney"), ("b", "America/New_York"), ("c", "America/New_York")], "queue string, timeZone string")
    seen = []
    for n, part in enumerate(deliveries(2)):
        land(src, f"{n}.json", part)
        seen += part
        stream = boards.read_files(spark, str(src), spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
        with states.rocks_state(spark):
            windows = states.newest_day_windows(stream, "at", zones, "queue", ["media"], "v")
            boards.run_available(windows, ck, states.newest_day_board(out, "queue", ["media"]), mode="update")
        table = spark.createDataFrame(seen, SCHEMA.replace("at timestamp", "at string")).withColumn("at", F.to_timestamp("at"))
        sums = table.filter("at IS NOT NULL").groupBy(F.window("at", "15 minutes")["start"].alias("intervalStart"), "media", "queue").agg(F.sum(F.coalesce("v", F.lit(0))).alias("total"))
        want = boards.latest_local_day(sums, "intervalStart", zones, ["queue"])
        board = spark.read.schema(windows.schema).parquet(out)
        names = ["intervalStart", "queue", "media", "total", "timeZone"]
        assert rows(states.newest_days(board).select(*names)) == rows(want.select(*names))
    # folders of days that no zone shows are gone
    days = {str(r[0]) for r in states.newest_days(board).select("day").distinct().collect()}
    assert min(d.removeprefix("day=") for d in os.listdir(out.removeprefix("file://")) if d.startswith("day=")) == min(days)
