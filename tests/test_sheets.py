"""Sheets by row position: numbering over splits, headers in any order, the first total row."""

from conftest import rows
from pyspark.sql import functions as F

from callweave.sources import sheets


def land(folder, name, lines, end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(end.join(lines) + end)


def test_lines_are_numbered_over_splits(spark, tmp_path):
    for name, n in (("a.csv", 500), ("b.csv", 3), ("c.csv", 90)):
        land(tmp_path / "in", name, [f"{name} line {i} {'x' * (i % 50)}" for i in range(1, n + 1)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = sheets.positioned_lines(spark, str(tmp_path / "in"))
        got = [(r["file"].rsplit("/", 1)[1], r["position"], r["line"]) for r in df.collect()]
        splits = spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits > 20 and len(got) == 593
    assert all(line.startswith(f"{name} line {at} ") for name, at, line in got)


def test_table_ends_at_the_first_total(spark, tmp_path):
    src = tmp_path / "sheets"
    land(src, "one.csv", ["title", "Name, Id ,Calls", 'x,1,"1,5"', "y,,3", "Total,9,9", "z,4,4", "Total,9,9"])
    land(src, "two.csv", ["title", "Calls,Other,Name", "7,o,u", "8,o"], end="\r\n")
    land(src, "short.csv", ["title"])
    df = sheets.table(sheets.positioned_lines(spark, str(src)), {"name": "Name", "id": "Id", "calls": "Calls"}, 2, width=5, total="Total", total_in="name")
    got = rows(df.select(F.element_at(F.split("file", "/"), -1).alias("f"), "position", "name", "id", "calls"))
    assert got == [("one.csv", 3, "x", "1", "1,5"), ("one.csv", 4, "y", None, "3"), ("two.csv", 3, "u", None, "7"), ("two.csv", 4, None, None, "8")]
    assert sheets.table(sheets.positioned_lines(spark, str(src)), {"name": "Name"}, 2).count() == 7
