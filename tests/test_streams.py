import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import scratch_path
from callweave.streaming import boards
from conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("user", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("v", T.LongType())])


def land(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("id", "user", "at", "v"), r))) for r in records))


def test_late_rows_beyond_the_bound_are_dropped_inside_it_kept(spark, tmp_path):
    src, out, ck = tmp_path / "in", scratch_path(spark, "out"), scratch_path(spark, "ck")

    def run():
        s = boards.read_files(spark, str(src), SCHEMA, files_per_trigger=1)
        board = boards.interval_metrics(s.withColumn("n", F.lit("m")), "at", ["user"], "n", "v", ["m", "absent"], "1 hour")
        boards.run_available(board, ck, boards.append_once(out))

    land(src, "a.json", (1, "u", "2024-01-01 10:00:00", 1))
    run()
    land(src, "b.json", (2, "u", "2024-01-01 12:00:00", 1), (3, "u", "2024-01-01 11:10:00", 5))
    run()
    land(src, "c.json", (4, "u", "2024-01-01 10:05:00", 100), (5, "u", "2024-01-01 11:14:00", 7), (6, "u", "2024-01-01 15:00:00", 1))
    run()
    got = {str(r["intervalStart"])[11:16]: (r["m"], r["absent"]) for r in spark.read.parquet(out).collect()}
    assert got == {"10:00": (1, 0), "11:00": (12, 0), "12:00": (1, 0)}


def test_latest_status_survives_a_replay(spark):
    path = scratch_path(spark, "status")
    sink = boards.upsert_newest(path, ["user"], F.col("id").desc(), buckets=4)
    first = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "a", 30)], "id long, user string, v long")
    second = spark.createDataFrame([(4, "b", 40), (0, "a", 0), (5, "c", 50)], "id long, user string, v long")
    for batch, df in ((0, first), (1, second), (1, second)):
        sink(df, batch)
    assert rows(spark.read.parquet(path).select("user", "id", "v")) == [("a", 3, 30), ("b", 4, 40), ("c", 5, 50)]


def test_windows_may_arrive_in_pieces_and_again(spark):
    path = scratch_path(spark, "win")
    sink = boards.extract_windows(path, ["id"], ["d"])
    schema = "id long, v string, d string"
    sink(spark.createDataFrame([(1, "x", "m"), (2, "x", "t")], schema), 0)
    sink(spark.createDataFrame([(3, "y", "m"), (1, "y", "m")], schema), 1)
    sink(spark.createDataFrame([(3, "y", "m"), (1, "y", "m")], schema), 1)
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "y", "m"), (2, "x", "t"), (3, "y", "m")]


def test_open_windows_show_and_are_corrected(spark, tmp_path):
    """Update mode over several runs equals a batch over all rows, the newest windows included."""
    src, out, ck = tmp_path / "open", scratch_path(spark, "out"), scratch_path(spark, "ck")
    files = [[(1, "u", "2024-01-01 10:00:00", 1)], [(2, "u", "2024-01-01 10:14:00", 4), (3, "v", "2024-01-01 10:20:00", 5)], [(4, "v", "2024-01-01 10:21:00", 6)]]
    for n, records in enumerate(files):
        land(src, f"{n}.json", *records)
        s = boards.read_files(spark, str(src), SCHEMA, files_per_trigger=1).withColumn("n", F.lit("m"))
        board = boards.interval_metrics(s, "at", ["user"], "n", "v", ["m"], "1 day").withColumn("day", F.to_date("intervalStart"))
        boards.run_available(board, ck, boards.extract_windows(out, ["intervalStart", "user"], ["day"]), mode="update")
    got = {(r["user"], str(r["intervalStart"])[11:16]): (r["m"], r["mCount"]) for r in spark.read.parquet(out).collect()}
    assert got == {("u", "10:00"): (5, 2), ("v", "10:15"): (11, 2)}


def test_the_board_shows_the_present(spark):
    state, out = scratch_path(spark, "state"), scratch_path(spark, "board")
    sink = boards.current_board(
        boards.upsert_newest(state, ["user"], F.col("id").desc(), buckets=4), state, out, lambda now: boards.queue_counts(now, "q", {"waiting": F.col("s") == "w"})
    )
    schema = "id long, user string, q string, s string"
    sink(spark.createDataFrame([(1, "a", "x", "w"), (2, "b", "x", "w")], schema), 0)
    assert rows(boards.newest_board(spark, out)) == [("x", 2)]
    for _ in range(2):
        sink(spark.createDataFrame([(3, "a", "x", "gone")], schema), 1)
    assert rows(boards.newest_board(spark, out)) == [("x", 1)]
