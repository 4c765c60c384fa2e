"""Scans, sinks, registration, SQL text and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import ts_text
from strandline.plans.catalogue.inputs import (
    SNAPSHOTS,
    TEXT_SNAPSHOTS,
    given,
    sql_double,
    sql_int,
    sql_moment,
    text_snapshots,
    without_zone,
)
from strandline.session import keep, scratch_path, settings
from strandline.sources.sql_text import run_sql
from strandline.sources.zones import (
    register_zone,
    scan_csv,
    table_path,
    write_csv,
    write_parquet,
)
from strandline.streaming.readings import (
    append_bounded,
    arriving,
    ingest,
    read_silver_stream,
    silver_exact,
)


def scan_csv_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv")
    write_csv(given(spark, folder, "events").withColumn("ts", ts_text("ts")), path)
    schema = "event_id long, ts string, user_id long, event_type string, value double, props string"
    events = scan_csv(spark, path, schema)
    turns = _odd_texts(given(spark, folder, "conversations"))
    texts = scratch_path(spark, "scan_csv_texts")
    write_csv(turns, texts, multiline=True)
    return events.unionByName(
        scan_csv(spark, texts, turns.schema, multiline=True).select(
            F.col("conv_id").alias("event_id"),
            F.col("role").alias("ts"),
            F.col("turn").cast("long").alias("user_id"),
            F.lit("turn").alias("event_type"),
            F.lit(None).cast("double").alias("value"),
            F.col("text").alias("props"),
        )
    )


def _odd_texts(turns: DataFrame) -> DataFrame:
    """Texts with quotes, commas, backslashes, line breaks, and empty and missing ones."""
    number = F.col("turn") + F.col("conv_id")
    odd = (
        F.when(number % 7 == 0, "")
        .when(number % 7 == 1, None)
        .when(number % 7 == 2, F.concat(F.lit('"say ""hi"", ok",\\\n'), "text"))
        .otherwise(F.concat("text", F.lit('\n"')))
    )
    return turns.withColumn("text", odd)


SCAN_CSV = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
FROM events
UNION ALL
SELECT conv_id, role, turn, 'turn', NULL,
       CASE (turn + conv_id) % 7 WHEN 0 THEN '' WHEN 1 THEN NULL
            WHEN 2 THEN '"say ""hi"", ok",\\' || chr(10) || text ELSE text || chr(10) || '"' END
FROM conversations
"""


def scan_split_csv_query(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents and conversations with line breaks, read in blocks that cut through texts."""
    path = scratch_path(spark, "scan_split_csv")
    turns = _odd_texts(given(spark, folder, "conversations")).select("conv_id", "turn", "role", "text")
    docs = given(spark, folder, "documents").withColumns({"turn": F.lit(3), "conv_id": F.col("doc_id")})
    rows = turns.unionByName(_odd_texts(docs).select("conv_id", "turn", F.col("lang").alias("role"), "text"))
    write_csv(rows, path, multiline=True)
    blocks = {"spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "0"}
    with settings(spark, blocks):
        found = scan_csv(spark, path, rows.schema, multiline=True, split_bytes=0)
        return keep(found.withColumn("text", F.md5("text")), "split-csv")


SCAN_SPLIT_CSV = """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT doc_id, 3, lang, text FROM documents
)
SELECT conv_id, turn, role,
       md5(CASE (turn + conv_id) % 7 WHEN 0 THEN '' WHEN 1 THEN NULL
           WHEN 2 THEN '"say ""hi"", ok",\\' || chr(10) || text ELSE text || chr(10) || '"' END) AS text
FROM rows
"""


def register_zone_query(spark: SparkSession, folder: str) -> DataFrame:
    zone = scratch_path(spark, "zone")
    events = given(spark, folder, "events").withColumn("ts", ts_text("ts"))
    orders = given(spark, folder, "orders").withColumn("o_orderdate", ts_text("o_orderdate"))
    write_csv(events, table_path(zone, "zone_events"))
    write_csv(orders, table_path(zone, "zone_orders"))
    columns = register_zone(spark, zone, "csv")
    sizes = spark.sql(
        """SELECT 'zone_events' AS table_name, count(*) AS table_rows FROM zone_events
           UNION ALL SELECT 'zone_orders', count(*) FROM zone_orders"""
    )
    return columns.join(sizes, "table_name").select(
        "table_name", "column_name", "data_type", "position", "table_rows"
    )


REGISTER_ZONE = """
SELECT table_name, column_name, data_type, CAST(position AS INTEGER) AS position, table_rows
FROM (VALUES ('zone_events', 'event_id', 'int', 0), ('zone_events', 'ts', 'timestamp', 1),
             ('zone_events', 'user_id', 'int', 2), ('zone_events', 'event_type', 'string', 3),
             ('zone_events', 'value', 'double', 4), ('zone_events', 'props', 'string', 5),
             ('zone_orders', 'o_orderkey', 'int', 0), ('zone_orders', 'o_custkey', 'int', 1),
             ('zone_orders', 'o_orderstatus', 'string', 2), ('zone_orders', 'o_totalprice', 'double', 3),
             ('zone_orders', 'o_orderdate', 'timestamp', 4), ('zone_orders', 'o_orderpriority', 'string', 5))
     AS c(table_name, column_name, data_type, position)
JOIN (SELECT 'zone_events' AS table_name, COUNT(*) AS table_rows FROM events
      UNION ALL SELECT 'zone_orders', COUNT(*) FROM orders) AS n USING (table_name)
"""


def sink_parquet_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sink_parquet")
    write_parquet(given(spark, folder, "lineitem"), path)
    return spark.read.parquet(path)


def sink_partitioned_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sink_partitioned")
    write_parquet(given(spark, folder, "events"), path, ["event_type"])
    return spark.read.parquet(path)


def sink_csv_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sink_csv")
    orders = given(spark, folder, "orders")
    write_csv(orders, path)
    texts = _odd_texts(given(spark, folder, "documents").withColumns({"turn": F.lit(3), "conv_id": F.col("doc_id")}))
    path_of_texts = scratch_path(spark, "sink_csv_texts")
    write_csv(texts, path_of_texts, multiline=True)
    back = scan_csv(spark, path_of_texts, texts.schema, multiline=True)
    return scan_csv(spark, path, orders.schema).unionByName(
        back.select(
            F.col("doc_id").alias("o_orderkey"),
            F.col("n_chars").alias("o_custkey"),
            F.col("lang").alias("o_orderstatus"),
            F.lit(None).cast("double").alias("o_totalprice"),
            F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
            F.md5("text").alias("o_orderpriority"),
        )
    )


SINK_CSV = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
UNION ALL
SELECT doc_id, n_chars, lang, NULL, NULL, md5(CASE (3 + doc_id) % 7 WHEN 0 THEN '' WHEN 1 THEN NULL
       WHEN 2 THEN '"say ""hi"", ok",\\' || chr(10) || text ELSE text || chr(10) || '"' END)
FROM documents
"""


def sql_text_query(spark: SparkSession, folder: str) -> DataFrame:
    bronze = given(spark, folder, "events").withColumn("ts", ts_text("ts"))
    bronze.createOrReplaceTempView("bronze_events")
    text = """
        SELECT date(date_parse(ts, '%Y-%m-%d %H:%i:%s')) AS day, event_type,
               ROUND(AVG(value), 1) AS avg_value, COUNT(*) AS n
        FROM bronze_events
        GROUP BY date(date_parse(ts, '%Y-%m-%d %H:%i:%s')), event_type
        ORDER BY day, event_type;
    """
    return run_sql(spark, text, output=scratch_path(spark, "sql_text"))


SQL_TEXT = """
SELECT CAST(ts AS DATE) AS day, event_type, ROUND(AVG(value), 1) AS avg_value, COUNT(*) AS n
FROM events GROUP BY 1, 2
"""


def stream_ingest_query(spark: SparkSession, folder: str) -> DataFrame:
    bronze = scan_csv(spark, _ingested(spark, folder), SNAPSHOTS.bronze_schema)
    kind = F.when(F.col("value") == "bad", F.col("value")).otherwise("number")
    return bronze.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        kind.alias("kind"),
        F.col("value").try_cast("double").alias("value"),
    )


def _arrivals(spark: SparkSession, folder: str) -> list[str]:
    """The text snapshots as CSV files of two sources."""
    rows = text_snapshots(spark, folder)
    first = F.pmod(F.crc32("event_type"), F.lit(2)) == 0
    paths = []
    for part in (rows.where(first), rows.where(~first)):
        paths.append(scratch_path(spark, "arrived"))
        write_csv(part, paths[-1])
    return paths


def _ingested(spark: SparkSession, folder: str) -> str:
    """Take the files of both sources into one Bronze table, each with its own checkpoint."""
    bronze = scratch_path(spark, "bronze")
    for arrived in _arrivals(spark, folder):
        stream = arriving(spark, arrived, SNAPSHOTS)
        ingest(stream, bronze, scratch_path(spark, "ingest-state")).awaitTermination()
    return bronze


def stream_silver_query(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams into one Silver table: one over all of Bronze, then one source once more."""
    silver = scratch_path(spark, "silver")
    for path in (_ingested(spark, folder), _arrivals(spark, folder)[1]):
        stream = arriving(spark, path, SNAPSHOTS)
        silver_exact(stream, SNAPSHOTS, silver, scratch_path(spark, "silver-state")).awaitTermination()
    return without_zone(read_silver_stream(spark, SNAPSHOTS, silver))


# Numbers are compared as numbers here: the engines write doubles differently.
STREAM_INGEST = f"""
SELECT event_id, ts, user_id, event_type, CASE WHEN value = 'bad' THEN value ELSE 'number' END AS kind,
       {sql_double('value')} AS value
FROM ({TEXT_SNAPSHOTS})
"""

STREAM_SILVER = f"""
SELECT DISTINCT event_id, {sql_moment('ts')} AS ts, {sql_int('user_id')} AS user_id, event_type,
       {sql_double('value')} AS value, CAST({sql_moment('ts')} AS DATE) AS day
FROM ({TEXT_SNAPSHOTS})
"""


# A snapshot's batch: most come in the order of their time, in two halves of the month; some come
# in the second or third batch whatever their time is, and all are sent once more one batch later.
BOUNDED_DELAY = 2  # days
BATCH_OF = """CASE WHEN event_id % 10 = 3 THEN 2 WHEN event_id % 10 = 4 THEN 1
                   WHEN dayofmonth(ts) > 15 THEN 1 ELSE 0 END"""


def stream_bounded_query(spark: SparkSession, folder: str) -> DataFrame:
    """Bounded Silver of three batches; the stream is started anew from its checkpoint for each."""
    base = scratch_path(spark, "bounded")
    rows = given(spark, folder, "events").withColumn("batch", F.expr(BATCH_OF))
    sent = rows.withColumn("batch", F.explode(F.array("batch", F.least(F.col("batch") + 1, F.lit(2)))))
    texts = sent.select(
        F.col("event_id").cast("string").alias("event_id"), ts_text("ts").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"), "event_type", F.col("value").cast("string").alias("value"),
        "batch",
    ).persist()
    for batch in range(3):
        write_csv(texts.where(F.col("batch") == batch).drop("batch"), f"{base}/arrived/{batch}")
        stream = arriving(spark, f"{base}/arrived", SNAPSHOTS)
        append_bounded(
            stream, SNAPSHOTS, f"{base}/silver", f"{base}/state", f"{BOUNDED_DELAY} days"
        ).awaitTermination()
    texts.unpersist()
    return without_zone(spark.read.schema(SNAPSHOTS.silver_schema).parquet(f"{base}/silver"))


# A batch's watermark lies the delay behind the latest time of the batches before it. What is not
# later than the watermark is dropped; copies of the rest are still known.
STREAM_BOUNDED = f"""
WITH sent AS (
  SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value,
         unnest([batch, least(batch + 1, 2)]) AS batch
  FROM (SELECT *, {BATCH_OF} AS batch FROM events)
), marks AS (
  SELECT b AS batch, (SELECT max(ts) FROM sent WHERE batch < b) - INTERVAL {BOUNDED_DELAY} DAY AS watermark
  FROM (VALUES (0), (1), (2)) AS n(b)
)
SELECT DISTINCT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value,
       CAST(ts AS DATE) AS day
FROM sent JOIN marks USING (batch) WHERE watermark IS NULL OR ts > watermark
"""


ENTRIES = {
    "scan_csv": (scan_csv_query, SCAN_CSV),
    "scan_split_csv": (scan_split_csv_query, SCAN_SPLIT_CSV),
    "register_zone": (register_zone_query, REGISTER_ZONE),
    "sink_parquet": (sink_parquet_query, "SELECT * FROM lineitem"),
    "sink_partitioned": (sink_partitioned_query, "SELECT * FROM events"),
    "sink_csv": (sink_csv_query, SINK_CSV),
    "sql_text": (sql_text_query, SQL_TEXT),
    "stream_ingest": (stream_ingest_query, STREAM_INGEST),
    "stream_silver": (stream_silver_query, STREAM_SILVER),
    "stream_bounded": (stream_bounded_query, STREAM_BOUNDED),
}
