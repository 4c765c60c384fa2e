"""Running SQL text against registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import PERCENT_FIELDS
from strandline.sources.zones import csv_read, write_csv, write_parquet

ROW = "_row"  # position of a stored result row


def register_functions(spark: SparkSession) -> None:
    """SQL functions that Spark has under no name: ``date_parse(text, percent_pattern)``.

    It is a SQL expression that Spark inlines, with the pattern folded to a constant. It
    knows the fields of ``java_pattern``, quotes other letters, and fails on unknown fields.
    """
    letters = "(?<![%A-Za-z])([A-Za-z]+)|(?<=%[A-Za-z])([A-Za-z]+)"
    java = f"""regexp_replace(pattern, r"{letters}", "'$1$2'")"""
    for field, java_field in PERCENT_FIELDS.items():
        if field != "%%":
            java = f"""replace({java}, "{field}", "{java_field}")"""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION java_pattern(pattern STRING) RETURNS STRING RETURN "
        f"""CASE WHEN contains(replace({java}, "%%", ""), "%")
                 THEN raise_error(concat("unknown date field in ", pattern))
                 ELSE replace({java}, "%%", "'%'") END"""
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION date_parse(value STRING, pattern STRING) "
        "RETURNS TIMESTAMP RETURN try_to_timestamp(value, java_pattern(pattern))"
    )


def run_sql(
    spark: SparkSession,
    text: str,
    database: str | None = None,
    output: str | None = None,
    form: str = "parquet",
) -> DataFrame:
    """Run one query; optionally in a database and with its rows stored.

    With ``output`` the query runs once and the stored rows are returned. As ``parquet`` they
    keep every type, nested ones too. Rows of a query that orders them have the column
    ``_row``, in whose order they are returned; those of any other query are not sorted. As ``csv`` the files are for other programs: there is no order, and types
    that CSV has no form for are an error.

    The text is Spark SQL, so an ascending ``ORDER BY`` puts nulls first unless it says
    ``NULLS LAST``, as the functions of this library do.
    """
    register_functions(spark)
    before = spark.catalog.currentDatabase()
    if database:
        spark.catalog.setCurrentDatabase(database)
    try:
        df = spark.sql(text.strip().rstrip(";"))
    finally:
        spark.catalog.setCurrentDatabase(before)
    if output is None:
        return df
    if form == "csv":
        write_csv(df, output, multiline=True)
        return df.sparkSession.read.options(**csv_read(multiline=True)).schema(df.schema).csv(output)
    if df._jdf.queryExecution().optimizedPlan().outputOrdering().isEmpty():
        write_parquet(df, output)
        return spark.read.parquet(output)
    # numbers grow with the partitions and inside them, which is the order of a sorted result
    write_parquet(df.withColumn(ROW, F.monotonically_increasing_id()), output)
    return spark.read.parquet(output).orderBy(ROW).drop(ROW)
