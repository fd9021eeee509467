"""Scans, sources and sinks over the given tables (written to and read back from the shared folder)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators import ordered
from callweave.queries.prelude import EVENTS, with_
from callweave.queries.registry import query
from callweave.session import cut_lineage, scratch_path
from callweave.sources import raw, readers, writers

PROPS = T.StructType([T.StructField("k", T.IntegerType())])
EVENT_FILE = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("props", PROPS),
        T.StructField("cents", T.LongType()),
    ]
)


def _event_json(t, copies=1):
    """Events landed as JSON lines; ``copies`` > 1 lands each record again."""
    path = scratch_path(t.spark, "events-json")
    rows = raw.event_rows(t.events).select(
        "eventId", "userId", "eventType", F.from_json("props", PROPS).alias("props"), "cents"
    )
    for _ in range(copies):
        rows.drop("eventId").write.mode("append").json(path)
    return path


@query(
    "s1_read_json_strict",
    with_(EVENTS) + "SELECT userId, eventType, k, cents FROM ev",
)
def read_json_strict(t):
    df = readers.read_json(t.spark, _event_json(t), EVENT_FILE)
    return df.select("userId", "eventType", "props.k", "cents")


@query(
    "s2_dedup_rows",
    with_(EVENTS) + "SELECT DISTINCT userId, eventType, k, cents FROM ev",
)
def dedup_rows(t):
    df = readers.dedup_rows(readers.read_json(t.spark, _event_json(t, copies=2), EVENT_FILE))
    return df.select("userId", "eventType", "props.k", "cents")


@query(
    "s3_add_lineage",
    """SELECT event_id, event_type, '2024-01-31' AS extractDate, '2024-01-01 00:00:00' AS extractIntervalStartTime,
       '2024-01-31 00:00:00' AS extractIntervalEndTime, '2024-02-01 06:00:00' AS recordInsertTime,
       event_id AS recordIdentifier FROM events""",
)
def add_lineage(t):
    return readers.add_lineage(
        t.events.select("event_id", "event_type"),
        "2024-01-31",
        "2024-01-01 00:00:00",
        "2024-01-31 00:00:00",
        insert_time=F.to_timestamp(F.lit("2024-02-01 06:00:00")),
        record_id=F.col("event_id"),
    )


@query(
    "s4_partition_key",
    """SELECT event_id, concat_ws('|', strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m-%d 00:00:00'),
       strftime(ts, '%Y-%m-%d 23:59:59')) AS sourcePartition FROM events""",
)
def partition_key(t):
    stamp = readers.partition_key(
        F.date_format("ts", "yyyy-MM-dd"),
        F.date_format("ts", "yyyy-MM-dd 00:00:00"),
        F.date_format("ts", "yyyy-MM-dd 23:59:59"),
    )
    return t.events.select("event_id", stamp.alias("sourcePartition"))


@query(
    "s5_size_files",
    "SELECT TRUE AS within, TRUE AS several, count(*) AS total_rows FROM lineitem",
)
def size_files(t):
    path = scratch_path(t.spark, "sized")
    writers.write_sized(t.lineitem, path, 2500)
    files = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(
        (F.max("n") <= 2500).alias("within"), (F.count(F.lit(1)) > 1).alias("several"), F.sum("n").alias("total_rows")
    )


@query(
    "s6_pick_up_json",
    with_(EVENTS)
    + "SELECT DISTINCT userId, eventType, k, cents, '2024-02-01 00:00:00' AS recordInsertTime FROM ev",
)
def pick_up_json(t):
    stamp = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    df = readers.pick_up_json(t.spark, _event_json(t, copies=2), EVENT_FILE, stamp)
    return df.select("userId", "eventType", "props.k", "cents", "recordInsertTime")


@query(
    "s7_delimited_dump",
    "SELECT doc_id, lang, text, NULL::VARCHAR AS reviewer FROM documents",
)
def delimited_dump(t):
    path = scratch_path(t.spark, "dump")
    record = F.concat(
        F.concat_ws(readers.FIELD_MARK, F.col("doc_id").cast("string"), "text", "lang"), F.lit(readers.ROW_MARK)
    )
    # the marks are UTF-16 bytes, so the rows are written as bytes without a further line mark
    t.documents.select(F.encode(record, "UTF-16LE").cast("string")).write.option("lineSep", "\n\n").option(
        "encoding", "UTF-16LE"
    ).text(path)
    target = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("reviewer", T.StringType()),
        ]
    )
    df = readers.read_delimited_dump(t.spark, path, ["doc_id", "text", "lang"], target)
    table = scratch_path(t.spark, "dump-table")
    readers.load_dump(df, table, "FULL")
    return t.spark.read.parquet(table)


@query(
    "s8_csv_clean_header",
    """SELECT CAST(c_custkey AS VARCHAR) AS Customer_No, c_name AS Customer_Name,
       c_mktsegment AS Market_Segment FROM customer""",
)
def csv_clean_header(t):
    path = scratch_path(t.spark, "csv")
    t.customer.select(
        F.col("c_custkey").alias("Customer No."),
        F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Market-Segment)"),
    ).write.options(**writers.CSV_OPTIONS).csv(path)
    return readers.read_csv_clean(t.spark, path)


@query(
    "s9_flatten_issue",
    with_(EVENTS)
    + """SELECT 'issue-' || eventId AS issueId, 'HD-' || eventId AS issueKey, 'HD' AS projectKey,
      CASE WHEN k % 4 <> 0 THEN 'P' || (k % 4) END AS priority, eventType AS status,
      CASE WHEN k % 5 <> 0 THEN userId END AS assigneeName, 'M' || (k % 3) AS market, 'Brand ' || (k % 7) AS brand,
      ts::VARCHAR AS createdDate, CASE WHEN k % 2 = 0 THEN (ts + to_seconds(k * 60))::VARCHAR END AS resolutionDate FROM ev""",
)
def flatten_issue(t):
    e = raw.event_rows(t.events)
    cell = F.concat(F.lit("M"), F.col("k") % 3, F.lit(" Brand "), F.col("k") % 7)
    docs = e.select(
        F.concat(F.lit("issue-"), "eventId").alias("id"),
        F.concat(F.lit("HD-"), "eventId").alias("key"),
        F.struct(
            F.struct(F.lit("HD").alias("key")).alias("project"),
            F.when(F.col("k") % 4 != 0, F.struct(F.concat(F.lit("P"), F.col("k") % 4).alias("name"))).alias("priority"),
            F.struct(F.col("eventType").alias("name")).alias("status"),
            F.when(F.col("k") % 5 != 0, F.struct(F.col("userId").alias("displayName"))).alias("assignee"),
            F.when(F.col("k") % 2 == 0, cell).alias("market_brand"),
            F.when(F.col("k") % 2 == 1, cell).alias("market_brand_alt"),
            F.col("ts").cast("string").alias("created"),
            F.when(F.col("k") % 2 == 0, raw.plus_seconds(F.col("ts"), F.col("k") * 60).cast("string")).alias("resolutiondate"),
        ).alias("fields"),
    )
    return readers.flatten_issue(docs)


@query(
    "s10_config_matrix",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
       UNION ALL SELECT 'n' || c_custkey, c_mktsegment FROM customer""",
)
def config_matrix(t):
    m = t.customer.select(
        F.array(
            F.array(F.lit("name"), F.lit("unused"), F.lit("id")),
            F.array("c_name", F.lit("-"), F.col("c_custkey").cast("string")),
            F.array("c_mktsegment", F.lit("-"), F.concat(F.lit("n"), F.col("c_custkey"))),
        ).alias("rows")
    )
    return readers.matrix_to_rows(m, "rows", ["id", "name"])


@query(
    "s11_split_cells",
    "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents",
)
def split_cells(t):
    return readers.split_cells(t.documents.select("doc_id", "text"), "text", "line").select("doc_id", "line")


@query(
    "s12_pack_struct",
    "SELECT c_custkey, c_name AS packedName, CAST(1 AS INTEGER) AS n FROM customer",
)
def pack_struct(t):
    packed = readers.pack_struct(t.customer, ["c_name", "c_mktsegment"], "attributes")
    assert "c_name" not in packed.columns
    return packed.select(
        "c_custkey", F.col("attributes")[0]["c_name"].alias("packedName"), F.size("attributes").alias("n")
    )


@query(
    "s13_late_metadata",
    """SELECT c.conv_id, c.turn, o.o_orderkey AS lineage_order, o.o_orderdate::VARCHAR AS lineage_time
       FROM conversations c JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
         FROM orders) o ON o.o_custkey = c.conv_id AND o.rn = 1""",
)
def late_metadata(t):
    lineage = ordered.newest(
        t.orders.select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"],
        F.col("o_orderdate").desc(),
        F.col("o_orderkey").desc(),
    )
    return t.conversations.join(lineage, F.col("conv_id") == F.col("o_custkey")).select(
        "conv_id", "turn", F.col("o_orderkey").alias("lineage_order"), F.col("o_orderdate").alias("lineage_time")
    )


@query(
    "s14_unpack_envelope",
    with_(EVENTS)
    + "SELECT eventId, userId, 'entry' AS kind FROM ev UNION ALL SELECT eventId, userId, 'exit' FROM ev",
)
def unpack_envelope(t):
    e = raw.event_rows(t.events)
    items = [F.struct("eventId", "userId", F.lit(kind).alias("kind")) for kind in ("entry", "exit")]
    return readers.unpack_envelope(e.select(F.lit(1).alias("page"), F.array(*items).alias("entities")), "entities")


@query(
    "s15_newest_run",
    """SELECT event_type AS endpoint, CAST(ts AS DATE)::VARCHAR AS extractDate, max(ts)::VARCHAR AS loadTime,
       CAST(1 AS BIGINT) AS recordCount FROM events GROUP BY 1, 2""",
)
def newest_run(t):
    ledger = t.events.select(
        F.col("event_type").alias("endpoint"),
        F.to_date("ts").alias("extractDate"),
        F.col("ts").alias("loadTime"),
        F.lit(1).cast("long").alias("recordCount"),
    )
    return readers.newest_run(ledger, "endpoint", "extractDate")


@query(
    "s16_csv_snapshot",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""",
)
def csv_snapshot(t):
    path = scratch_path(t.spark, "snapshot-csv")
    writers.write_csv_snapshot(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate"), path)
    return t.spark.read.option("header", True).csv(path)


@query(
    "s17_parquet_snapshot",
    "SELECT o_orderkey, o_orderstatus AS slice, o_totalprice FROM orders",
)
def parquet_snapshot(t):
    path = scratch_path(t.spark, "snapshot-parquet")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("slice"), "o_totalprice")
    writers.write_parquet_snapshot(rows, path, "slice")
    return t.spark.read.parquet(path)


@query(
    "s18_numbered_batches",
    """SELECT conv_id, turn, CAST(ceil(row_number() OVER (ORDER BY conv_id, turn) / 100.0) AS INTEGER) AS batch
       FROM conversations""",
)
def numbered_batches(t):
    path = scratch_path(t.spark, "batches")
    writers.write_batches(t.conversations.select("conv_id", "turn"), path, ["conv_id", "turn"], 100)
    return t.spark.read.schema("conv_id long, turn long, batch int").option("header", True).csv(path)


@query(
    "s19_cyclic_workers",
    """SELECT doc_id, (['east', 'west', 'north'])[(row_number() OVER (ORDER BY doc_id) - 1) % 3 + 1] AS worker
       FROM documents""",
)
def cyclic_workers(t):
    return writers.assign_cyclic(t.documents.select("doc_id"), ["doc_id"], ["east", "west", "north"])


@query(
    "s20_window_export",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'fact' AS kind FROM orders
         WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1998-01-01'
       UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'dim' FROM nation""",
)
def window_export(t):
    fact, dim = scratch_path(t.spark, "fact"), scratch_path(t.spark, "dim")
    writers.write_window_export(t.orders, fact, "o_orderdate", "1997-01-01", "1998-01-01")
    writers.write_csv_snapshot(t.nation, dim, single_file=True)
    read = t.spark.read.option("header", True)
    return (
        read.csv(fact)
        .select(F.col("o_orderkey").alias("id"), F.lit("fact").alias("kind"))
        .union(read.csv(dim).select(F.col("n_nationkey").alias("id"), F.lit("dim").alias("kind")))
    )


# fixed values: keywords per (region, wrap code) looked for in a part name
KEYWORDS = [
    ("AMERICA", "code-1", "red"),
    ("AMERICA", "code-2", "blue"),
    ("EUROPE", "code-1", "small"),
    ("EUROPE", "code-3", "bolt"),
    ("ASIA", "code-4", "ring"),
]


@query(
    "s21_keyword_table",
    """WITH kw(region, wrapCode, keyword) AS (VALUES ('AMERICA', 'code-1', 'red'), ('AMERICA', 'code-2', 'blue'),
         ('EUROPE', 'code-1', 'small'), ('EUROPE', 'code-3', 'bolt'), ('ASIA', 'code-4', 'ring'))
       SELECT region, wrapCode, keyword, p_partkey FROM part JOIN kw ON list_contains(string_split(p_name, ' '), keyword)""",
)
def keyword_table(t):
    keywords = t.spark.createDataFrame(KEYWORDS, "region string, wrapCode string, keyword string")
    words = t.part.select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("keyword"))
    return words.join(F.broadcast(keywords), "keyword").select("region", "wrapCode", "keyword", "p_partkey")


@query(
    "s22_csv_payload",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal < 1000 THEN '' ELSE c_mktsegment END AS segment,
       '2024-01-31' AS extractDate FROM customer""",
)
def csv_payload(t):
    path = scratch_path(t.spark, "payload")
    t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") >= 1000, F.col("c_mktsegment")).alias("segment"),
    ).write.options(**writers.CSV_OPTIONS).csv(path)
    df = readers.read_csv_payload(t.spark, path, T.StructType.fromDDL("id string, segment string"))
    stamped = readers.add_lineage(df, "2024-01-31", "2024-01-30 00:00:00", "2024-01-31 00:00:00")
    # written once, so that the record ids do not change between reads
    return cut_lineage(stamped).select("id", "segment", "extractDate")
