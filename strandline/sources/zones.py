"""Reading, writing and registering the table folders of a zone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.schemas import HOSPITAL, MOMENT, Table
from strandline.session import at_once, bytes_below
from strandline.sources.infer import infer_csv
from strandline.sources.multiline import largest_file, scan_split_csv
from strandline.sources.runs import current_path, current_tables

# The dialect of common CSV writers. A quote inside quoted text is doubled,
# an empty text is "" and a null is nothing. Files in folders below the table folder belong
# to the table: streamed batches come in folders of their own. Headers are checked against
# the declared columns.
CSV_READ = {
    "header": "true",
    "recursiveFileLookup": "true",
    "enforceSchema": "false",
    "quote": '"',
    "escape": '"',
    # what no file holds: nothing between two commas is null, and "" is not
    "nullValue": "\u0000",
    "emptyValue": "",
}
# Text goes out as it is, with its blanks.
CSV_WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def csv_read(multiline: bool = False) -> dict[str, str]:
    """Reading options. With ``multiline`` a file whose texts hold line breaks is read as a whole."""
    return CSV_READ | {"multiLine": str(multiline).lower()}


def table_path(zone: str, table: str) -> str:
    return f"{zone.rstrip('/')}/{table}"


# --- reading ---


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    multiline: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """CSV with a header line.

    With a schema the files are read once, and a file whose header does not name
    the columns in that order fails the job instead of filling the wrong columns;
    ``infer=True`` costs a further pass. ``multiline`` is for files with line breaks
    in quoted text. Each of them is then read by one task, or, if one is larger than
    ``split_bytes`` (by default the size of a split), all of them block by block.
    """
    reader = spark.read.options(**csv_read(multiline))
    if schema is not None:
        if multiline and _needs_splitting(spark, path, split_bytes):
            kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            return scan_split_csv(spark, path, kinds, csv_read())
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", str(infer).lower()).csv(path)


def _needs_splitting(spark: SparkSession, path: str, split_bytes: int | None) -> bool:
    if split_bytes is None:
        in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        split_bytes = in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return bytes_below(spark, path) > split_bytes and largest_file(spark, path) > split_bytes


def read_bronze(spark: SparkSession, zone: str, table: Table) -> DataFrame:
    path = table_path(zone, table.name)
    return scan_csv(spark, path, table.bronze_schema, multiline=table.multiline)


def read_curated(spark: SparkSession, zone: str, table: str | Table) -> DataFrame:
    """A Silver or Gold table as the last whole run left it. Known tables come back in their declared column order."""
    if isinstance(table, Table):
        schema = table.silver_schema
        df = spark.read.schema(schema).parquet(current_path(spark, zone, table.name))
        return df.select(*schema.names)  # partition columns are read last
    return spark.read.parquet(current_path(spark, zone, table))


# --- writing: every write replaces the whole table ---


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table.

    For a partitioned table the rows are first rebalanced on the partition
    columns: small partitions get one file, and one that holds most of the rows
    is split over many tasks by adaptive execution.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, multiline: bool = False) -> None:
    """Replace a CSV table.

    Unless it is ``multiline``, a text with a line break fails the job: who reads the
    table line by line would see two broken rows.
    """
    if not multiline:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        error = F.raise_error("line break in a table that is not multiline")
        df = df.select(
            *[
                F.when(F.col(f"`{c}`").rlike(r"[\r\n]"), error).otherwise(F.col(f"`{c}`")).alias(c)
                if c in texts
                else F.col(f"`{c}`")
                for c in df.columns
            ]
        )
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# --- registering ---


def register_zone(
    spark: SparkSession,
    zone: str,
    source: str,
    database: str | None = None,
    known: Mapping[str, Table] = HOSPITAL,
) -> DataFrame:
    """Find the table folders of a zone and make them queryable by name.

    ``source`` is ``csv`` or ``parquet``. With a ``database`` external tables are
    created in it, else temporary views. Parquet files carry their types, and
    ``known`` CSV tables are declared, with timestamps left as text; the types of
    any other CSV table are inferred, which reads its files once, all tables at the same time.

    An external table of the same name is registered anew; that of a Parquet table without
    partitions only has its location moved, to the last whole run, so it is there all the
    time. A managed table of that name owns its files, so it is left alone and the call fails.

    Returns (table_name, column_name, data_type, position), one row per column.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    tables = current_tables(spark, zone)

    def schema_of(name: str) -> T.StructType:
        table = known.get(name)
        if source == "csv":
            return crawled_schema(table) if table else infer_csv(spark, tables[name], csv_read())
        return spark.read.parquet(tables[name]).schema

    schemas = dict(zip(tables, at_once(spark, schema_of, list(tables))))
    found = []
    for name, path in tables.items():
        if source == "csv":
            table = known.get(name)
            reading = csv_read(bool(table and table.multiline))
            df = scan_csv(spark, path, schemas[name], multiline=bool(table and table.multiline))
        else:
            df = spark.read.schema(schemas[name]).parquet(path)
        if database:
            full = f"`{database}`.`{name}`"
            if source == "parquet" and _moved(spark, full, path, df):
                found += _described(name, df)
                continue
            _drop_external(spark, full)
            if source == "csv":
                spark.catalog.createTable(full, path, source, df.schema, **reading)
            else:
                spark.catalog.createTable(full, path, source)
                if any(c.isPartition for c in spark.catalog.listColumns(full)):
                    spark.catalog.recoverPartitions(full)
        else:
            df.createOrReplaceTempView(name)
        found += _described(name, df)
    return spark.createDataFrame(
        found, "table_name string, column_name string, data_type string, position int"
    )


def _described(name: str, df: DataFrame) -> list[tuple[str, str, str, int]]:
    return [(name, f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]


def _moved(spark: SparkSession, full: str, path: str, df: DataFrame) -> bool:
    """Point an external table to new files of the same columns, if it has no partitions."""
    if not spark.catalog.tableExists(full) or spark.catalog.getTable(full).tableType != "EXTERNAL":
        return False
    if spark.table(full).dtypes != df.dtypes or any(c.isPartition for c in spark.catalog.listColumns(full)):
        return False
    spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
    spark.catalog.refreshTable(full)
    return True


def _drop_external(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        return
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is a managed table; dropping it would delete its data")
    spark.sql(f"DROP TABLE {name}")


def crawled_schema(table: Table) -> T.StructType:
    """Types a crawler would find: numbers as numbers, timestamps as text."""
    silver = table.silver_schema
    kinds = {c: T.StringType() if k == MOMENT else silver[c].dataType for c, k in table.columns.items()}
    return T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
