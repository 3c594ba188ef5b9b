"""Delimited text of another writer: backslash escapes, quotes, raw line breaks in values, bad bytes.

A value may hold a line break that is escaped or stands inside quotes, so where a record
ends depends on all that comes before it. Spark cuts the files into ranges and reads
their lines; in each range the unescaped quotes are counted, the counts are summed over
the ranges of a file, and each range then knows whether it begins inside quotes. From
that its own lines know which of their breaks end a record. A window holds the lines of
one range or the ranges of one file, never a whole file's lines, and only records of
several lines are put together by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from lodestar.functions.reserved import TEXT_TIMESTAMP
from lodestar.session import cut_lineage
from lodestar.sources.extract_files import CORRUPT

#: Marks what a backslash escaped while quotes and delimiters are looked at; a mark in the text is escaped itself.
_MARK = "\ue000"


def _masked(line: Column, delimiter: str) -> Column:
    """A line in which every quote and delimiter counts, and a backslash only at its end."""
    pairs = [(_MARK, "0"), ("\\\\", "1"), (f"\\{delimiter}", "2"), ('\\"', "3"), ("\\\r", "4")]
    for text, code in pairs:
        line = F.replace(line, F.lit(text), F.lit(_MARK + code))
    # a backslash before any other character says nothing
    return F.regexp_replace(line, r"\\(?!$)", "")


def _unmasked(value: Column, delimiter: str) -> Column:
    for code, text in [("4", "\r"), ("3", '"'), ("2", delimiter), ("1", "\\"), ("0", _MARK)]:
        value = F.replace(value, F.lit(_MARK + code), F.lit(text))
    return value


def _valid(line: Column, replacement: str) -> Column:
    """``line`` with bytes that are no UTF-8 replaced."""
    clean = F.replace(F.make_valid_utf8(line), F.lit("\ufffd"), F.lit(replacement))
    return F.when(F.is_valid_utf8(line), line).otherwise(clean)


def _lines(spark: SparkSession, path: str, delimiter: str, replacement: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    line = _masked(_valid(F.col("value"), replacement), delimiter)
    placed = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), line.alias("line"),
    )
    escaped = F.col("line").endswith("\\")
    return placed.withColumns(
        {
            "escaped": escaped,
            "line": F.when(escaped, F.expr("left(line, char_length(line) - 1)")).otherwise(F.col("line")),
            "quotes": F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit(""))),
        }
    )


def _before(lines: DataFrame, count: str) -> DataFrame:
    """``file, block`` and the sum of ``count`` over the earlier ranges of the file."""
    ranges = lines.groupBy("file", "block").agg(F.sum(count).alias("own"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "block", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias(f"{count}_before"))


def foreign_records(spark: SparkSession, path: str, delimiter: str = ",", replacement: str = "?") -> DataFrame:
    """``file, number, record`` of every record, numbered from 0 in its file; records are masked."""
    own = Window.partitionBy("file", "block").orderBy("place")
    upto, earlier = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    lines = _lines(spark, path, delimiter, replacement)
    lines = cut_lineage(lines.withColumn("seen", F.sum("quotes").over(upto)))
    lines = lines.join(_before(lines, "quotes"), ["file", "block"])
    ends = ~F.col("escaped") & ((F.col("quotes_before") + F.col("seen")) % 2 == 0)
    lines = lines.select("file", "block", "place", "line", ends.cast("long").alias("ends"))
    lines = cut_lineage(lines.withColumn("done", F.coalesce(F.sum("ends").over(earlier), F.lit(0))))
    lines = lines.join(_before(lines, "ends"), ["file", "block"]).withColumn("number", F.col("ends_before") + F.col("done"))
    # a line is a whole record if it ends one and no line before it belongs to the same
    after = F.lag("number").over(own)
    lines = cut_lineage(
        lines.withColumn("first", F.col("number") != F.coalesce(after, F.lit(-1))).withColumn("at_edge", after.isNull())
        .select("file", "block", "place", "line", "ends", "number", "first", "at_edge")
    )
    whole = (F.col("ends") == 1) & F.col("first") & ~(F.col("at_edge") & (F.col("block") > 0))
    single = lines.filter(whole).select("file", "number", F.col("line").alias("record"))
    pieces = lines.filter(~whole).groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("all"))
    return single.unionByName(pieces.select("file", "number", F.array_join(F.transform("all", lambda p: p["line"]), "\n").alias("record")))


def _typed(value: Column, field: T.StructField, timestamps: str) -> Column:
    if isinstance(field.dataType, T.StringType):
        return value
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.try_to_timestamp(value, F.lit(timestamps)).cast("timestamp_ntz")
    if isinstance(field.dataType, T.TimestampType):
        return F.try_to_timestamp(value, F.lit(timestamps))
    return value.try_cast(field.dataType)


def read_foreign(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True,
    timestamps: str = TEXT_TIMESTAMP, replacement: str = "?",
) -> DataFrame:
    """Rows of files in the warehouse's own load dialect, typed by ``schema``.

    A backslash takes a delimiter, quote, line break or backslash literally, and is dropped before anything
    else. Quotes around a value go, and keep delimiters and line breaks inside; a quote that is part of a value
    has to be escaped. An empty value is an empty text, and null in the other types. Bytes that
    are no UTF-8 become ``replacement``. The first record of each file is left out with
    ``header``. A record with another number of values, or with one that its type cannot
    take, stands whole in the corrupt column, with what could be read.
    """
    records = foreign_records(spark, path, delimiter, replacement)
    rows = records.filter(F.col("number") > 0) if header else records
    d = "\\" + delimiter if not delimiter.isalnum() else delimiter
    # read as a literal so that the pattern's own backslashes survive
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), F.col("record")), F.lit(f'{d}("[^"]*"[^{d}]*|[^{d}]*)'), F.lit(1))
    split = rows.select("record", found.alias("found"))
    raw = []
    for i in range(len(schema)):
        part = F.get("found", F.lit(i))
        quoted = (F.char_length(part) >= 2) & part.startswith('"') & part.endswith('"')
        raw.append(_unmasked(F.when(quoted, F.expr(f"substring(get(found, {i}), 2, char_length(get(found, {i})) - 2)")).otherwise(part), delimiter).alias(f"v{i}"))
    values = split.select("record", F.size("found").alias("n"), *raw)
    typed = [_typed(F.col(f"v{i}"), f, timestamps).alias(f.name) for i, f in enumerate(schema.fields)]
    lost = [
        F.col(f"v{i}").isNotNull() & (F.col(f"v{i}") != "") & _typed(F.col(f"v{i}"), f, timestamps).isNull()
        for i, f in enumerate(schema.fields)
    ]
    bad = F.col("n") != len(schema)
    for x in lost:
        bad = bad | x
    return values.select(*typed, F.when(bad, _unmasked(F.col("record"), delimiter)).alias(CORRUPT))
