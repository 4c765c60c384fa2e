"""CSV files with line breaks in quoted text, read by many tasks.

A file is cut into blocks like any text file. Whether a block begins inside quotes follows
from the number of quotes before it, that is from one bit per block. With it every task
knows where records end. Only the record that crosses from one block to the next is put
together from fragments. The records' texts are then parsed by Spark's CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators.joins import BROADCAST_BYTES, join_checked, planned_bytes
from strandline.session import keep, settings

# What a row of found text is: a whole record, the start of one, its end, or a block without an end.
RECORD, START, END, MIDDLE = range(4)
TEXT_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000"}
# Options of the parser; where a file begins or a line ends does not concern it.
PARSER = ("quote", "escape", "nullValue", "emptyValue")


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file of a folder; only the folder is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    return files.coalesce(spark.sparkContext.defaultParallelism).agg(F.max("length")).first()[0] or 0


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines and the block they lie in: ``value, file, start, length``."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    block = F.col("_metadata")
    return lines.select(
        "value",
        block["file_path"].alias("file"),
        block["file_block_start"].alias("start"),
        block["file_block_length"].alias("length"),
    )


def text_blocks(lines: DataFrame) -> DataFrame:
    """Stored blocks (file, start, length, block, inside, first): does it begin inside quotes, is it the file's first.

    ``block`` numbers them. A file with an odd number of quotes is an error.
    """
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start", "length").agg(F.sum(quotes).alias("quotes"))
    order = Window.partitionBy("file").orderBy("start")  # a row per block
    before = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("quotes").over(Window.partitionBy("file"))
    odd = F.raise_error(F.concat(F.lit("a quote is not closed in "), "file"))
    return keep(
        counted.select(
            "file", "start", "length",
            F.monotonically_increasing_id().alias("block"),
            (F.when(whole % 2 == 1, odd.cast("long")).otherwise(before) % 2).cast("int").alias("inside"),
            (F.row_number().over(order) == 1).alias("first"),
        ),
        "text-blocks",
    )


class Block:
    """What a task knows of the block it is reading."""

    def __init__(self, number: int, inside: int, first: bool):
        self.number, self.parity = number, inside
        self.head, self.first = bool(inside), first
        self.open: list[str] = []  # lines of the record that has not ended yet

    def rest(self) -> list[tuple]:
        """What is left at the end of the block."""
        if not self.open:
            return []
        return [("\n".join(self.open), MIDDLE if self.head else START, self.number, self.first)]

    def take(self, lines: pa.Array, quotes: np.ndarray) -> tuple[list[tuple], pa.Array]:
        """(rows for the record that had begun before, records that begin and end in these lines)."""
        parity = (self.parity + np.cumsum(quotes)) & 1
        self.parity = int(parity[-1])
        ends = np.flatnonzero(parity == 0) + 1
        if not len(ends):
            self.open += lines.to_pylist()
            return [], lines.slice(0, 0)
        text = "\n".join(self.open + lines.slice(0, ends[0]).to_pylist())
        begun = [(text, END if self.head else RECORD, self.number, self.first)]
        inner = pa.ListArray.from_arrays(
            pa.array(ends - ends[0], pa.int32()), lines.slice(ends[0], ends[-1] - ends[0])
        )
        self.open = lines.slice(ends[-1]).to_pylist()
        self.head = self.first = False
        return begun, pc.binary_join(inner, "\n")


def found_texts(lines: DataFrame, blocks: DataFrame, fragments: bool) -> DataFrame:
    """(text, kind, block, header) of all whole records, or of the fragments at the blocks' ends."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        names = ["text", "kind", "block", "header"]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            wanted = [r for r in found if (r[1] != RECORD) == fragments]
            texts, kinds, numbers, headers = zip(*wanted) if wanted else ((), (), (), ())
            kinds_of = (pa.string(), pa.int32(), pa.int64(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip((texts, kinds, numbers, headers), kinds_of)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            values = batch.column("value")
            if not pa.types.is_string(values.type):
                values = values.cast(pa.string())
            quotes = pc.count_substring(values, '"').to_numpy()
            numbers = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if block is None or block.number != numbers[lo]:
                    if block is not None:
                        yield rows(block.rest())
                    block = Block(int(numbers[lo]), batch.column("inside")[lo].as_py(), batch.column("first")[lo].as_py())
                begun, inner = block.take(values.slice(lo, hi - lo), quotes[lo:hi])
                yield rows(begun)
                if len(inner) and not fragments:
                    same = (pa.scalar(RECORD, pa.int32()), pa.scalar(block.number, pa.int64()), pa.scalar(False))
                    yield pa.RecordBatch.from_arrays([inner, *[pa.repeat(x, len(inner)) for x in same]], names)
        if block is not None:
            yield rows(block.rest())

    # a join by broadcast leaves the lines in their order
    known = lines.join(F.broadcast(blocks), ["file", "start", "length"], "left")
    changed = F.raise_error(F.lit("files, or the size of their splits, have changed since the blocks were counted"))
    with_block = known.select("value", F.coalesce("block", changed.cast("long")).alias("block"), "inside", "first")
    return with_block.mapInArrow(split, "text string, kind int, block long, header boolean")


def put_together(fragments: DataFrame, blocks: DataFrame) -> DataFrame:
    """(text, header) of the records that cross from one block to another: a start and what follows up to the end."""
    placed = join_checked(fragments, blocks.select("block", "file", "start"), "block")
    # an end belongs to a record of a block before, a start of the same block comes after it
    order = Window.partitionBy("file").orderBy("start", (F.col("kind") == START).cast("int"))
    numbered = placed.withColumn("record", F.sum((F.col("kind") == START).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    return numbered.groupBy("file", "record").agg(
        F.concat_ws("\n", F.transform(parts, lambda p: p["text"])).alias("text"), F.max("header").alias("header")
    )


def scan_split_csv(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """Rows of CSV files with a header line and any line breaks in quoted text, read block by block.

    The result is that of reading each file as a whole with these ``options``: the same
    columns, a header that differs from them fails the job, empty lines are skipped. Quotes
    stand around fields, and doubled inside; a file that leaves one open fails the job. Line
    breaks in texts stay as they are, ``\\r\\n`` too. Records end with ``\\n`` or ``\\r\\n``.

    The files are read three times: for the quotes, for the fragments, and for the rows. The
    last one happens when the result is used; if files have changed by then, or the settings
    that cut them into splits, the job fails. A row per block is broadcast; where these are
    too many, the files are so as well, and each is read by one task.
    """
    lines = text_lines(spark, path)
    blocks = text_blocks(lines)
    if planned_bytes(blocks) > BROADCAST_BYTES:
        return spark.read.options(**options).option("multiLine", "true").schema(schema).csv(path)
    with settings(spark, TEXT_BATCHES):
        crossing = keep(found_texts(lines, blocks, True), "fragments")
        crossing = keep(put_together(crossing, blocks), "crossing")
    whole = found_texts(lines, blocks, False).select("text", "header")
    records = whole.unionByName(crossing.select("text", "header")).withColumn(
        "text", F.regexp_replace("text", r"\r\z", "")
    )
    parser = {name: options[name] for name in PARSER if name in options}

    def parsed(fields: list[T.StructField]) -> Column:
        return F.from_csv("text", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), parser)

    # one more than there should be
    header = [T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields) + 1)]
    names = F.array(*[F.lower(parsed(header)[f.name]) for f in header])
    expected = F.array(*[F.lower(F.lit(f.name)) for f in schema.fields], F.lit(None).cast("string"))
    differs = F.raise_error(F.concat(F.lit("the header is not that of the table: "), "text")).cast("boolean")
    is_row = F.when(~F.col("header"), F.col("text") != "").when(names.eqNullSafe(expected), False).otherwise(differs)
    return records.where(is_row).select(parsed(schema.fields).alias("row")).select("row.*")
