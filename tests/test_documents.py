"""Documents of changing shape, and types of declared targets."""

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators import documents as dc
from callweave.plans import targets


def test_fields_that_come_go_and_change_type(spark):
    texts = [
        '{"id":{"oid":"a"},"t":"2024-01-01T10:00:00.000Z","n":1.5,"x":[{"v":1},{"v":"two"}]}',
        '{"id":"b","t":1704103200000,"n":"1.5","x":{"v":3}}',
        '{"id":7,"t":{"$date":1704103200000},"n":"none","x":[]}',
        '{"t":"soon","x":null}',
        "no json {",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").withColumn("d", dc.parsed(F.col("text")))
    d = F.col("d")
    got = rows(df.select("i", dc.id_at(d, "id"), dc.time_at(d, "t").cast("string"), dc.at(d, "n", "double")))
    at = "2024-01-01 10:00:00"
    assert got == [(0, "a", at, 1.5), (1, "b", at, 1.5), (2, "7", at, None), (3, None, None, None), (4, None, None, None), (5, None, None, None)]
    each = df.select("i", F.explode(dc.entries_at(d, "x")).alias("x"))
    assert rows(each.select("i", dc.at(F.col("x"), "v"))) == [(0, "1"), (0, "two"), (1, "3"), (3, None), (4, None), (5, None)]


def test_target_types_follow_the_names():
    want = {
        "agentId": T.LongType(), "isOutbound": T.BooleanType(), "useACW": T.BooleanType(), "holdSeconds": T.DoubleType(), "totalTalkTime": T.DoubleType(), "holdCount": T.LongType(),
        "lastUpdateTime": T.TimestampType(), "extractDate": T.TimestampType(), "teamName": T.StringType(), "primaryDispositionId": T.LongType(), "timeZone": T.StringType(),
    }
    assert {n: targets.kind(n) for n in want} == want
    assert (len(targets.REPLACED), len(targets.APPENDED)) == (13, 5)


def test_loads_replace_or_add(spark, tmp_path):
    rows_ = spark.createDataFrame([("1", "x", "true", "k"), ("1", "x", "true", "k"), (None, None, None, None)], "dispositionId string, dispositionName string, isActive string, more string")
    for _ in range(2):
        targets.load(rows_, "dispositions_skills", f"{tmp_path}/d")
    got = spark.read.parquet(f"{tmp_path}/d")
    assert got.schema == targets.target("dispositions_skills").schema and got.count() == 2
    assert rows(got.select("dispositionId", "isActive", "skills")) == [(1, True, None), (None, None, None)]
    for _ in range(2):
        targets.load(rows_.select(F.col("dispositionId").alias("contactId")), "contact_custom_data", f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c").count() == 4
    targets.load(rows_.limit(0), "dispositions_skills", f"{tmp_path}/e")
    assert spark.read.parquet(f"{tmp_path}/e").count() == 0
