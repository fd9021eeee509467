import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators import kpi
from callweave.session import scratch_path
from callweave.sources import readers, writers
from conftest import rows

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def land(spark, *lines):
    path = scratch_path(spark, "land")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_record_fails_the_read(spark):
    path = land(spark, '{"a": 1, "b": "x"}', '{"a": oops')
    with pytest.raises(Exception, match="FAILFAST"):
        readers.read_json(spark, path, SCHEMA).collect()
    assert readers.read_json(spark, path, SCHEMA, strict=False).count() == 2


def test_dump_with_newlines_inside_a_field(spark, tmp_path):
    text = "1<EOFD>line one\nline two<EOFD><EORD>\r\n2<EOFD>zwei ü<EOFD>x<EORD>\r\n"
    (tmp_path / "dump.txt").write_bytes(text.encode("utf-16"))
    target = T.StructType([T.StructField("c", T.StringType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("d", T.DateType())])
    out = readers.read_delimited_dump(spark, str(tmp_path / "dump.txt"), ["a", "b", "c"], target)
    assert rows(out) == [("x", 2, "zwei ü", None), (None, 1, "line one\nline two", None)]


@pytest.mark.parametrize("text, name", [("Agent No.", "Agent_No"), ("Share (%)", "Share"), ("ok_name", "ok_name"), (" a-b ", "a_b")])
def test_clean_name(text, name):
    assert readers.clean_name(text) == name


def test_ledger(spark):
    ledger = spark.sql(
        "select 'users' endpoint, date'2024-01-01' extractDate, timestamp'2024-01-01 00:00:00' extractIntervalStartTime, timestamp'2024-01-02 00:00:00' extractIntervalEndTime"
    )
    window = ("2024-01-01", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert readers.ledger_has(ledger, "users", *window)
    assert not readers.ledger_has(ledger, "queues", *window)


def test_batches_cover_everything_once(spark):
    df = spark.range(0, 1003)
    out = writers.batch_numbers(df, ["id"], 100)
    sizes = {r["batch"]: r["count"] for r in out.groupBy("batch").count().collect()}
    assert sizes == {**{i: 100 for i in range(1, 11)}, 11: 3}
    parts = [df.filter(writers.shares(df, 4, "id") == i) for i in range(4)]
    assert sum(p.count() for p in parts) == 1003


def test_files_are_not_larger_than_asked(spark, tmp_path):
    writers.write_sized(spark.range(0, 101, 1, 1), str(tmp_path / "sized"), 10)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "sized")).groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) == 10 and sum(sizes) == 101


@pytest.mark.parametrize("text", ["sum(a)", "a; drop table x", "a || b", "unknown + 1", "(select 1)", "java_method('x')"])
def test_formulas_outside_the_allow_list_are_refused(text):
    with pytest.raises(kpi.BadFormula):
        kpi.checked(text, ["a", "b"])


def test_formula_rows(spark):
    df = spark.createDataFrame([("u", 1, 2), ("u", 3, None), ("w", None, 5), ("z", 4, 0)], "user string, a int, b int")
    out = kpi.ratio_kpis(df, [kpi.Formula("k", "a", "sum", "b", "sum")], ["user"])
    assert rows(out) == [("u", "k", 1.0, 2.0, 0.5), ("z", "k", 4.0, 0.0, None)]
    with pytest.raises(kpi.BadFormula):
        kpi.ratio_kpis(df, [kpi.Formula("k", "a", "reflect", "b", "sum")], ["user"])
    marks = kpi.high_water_mark(df.filter("user = 'u'"), "user", "a")
    assert rows(kpi.newer_than_mark(df, marks, "user", "a").select("user")) == [("w",), ("z",)]


def test_matrix_without_a_column(spark):
    df = spark.createDataFrame([([["a", "b"], ["1", "2"], ["3"]],)], "m array<array<string>>")
    assert rows(readers.matrix_to_rows(df, "m", ["b", "a"])) == [("2", "1"), (None, "3")]
    assert F is not None
