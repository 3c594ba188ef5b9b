"""Extract files in one global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodestar.operators.ordering import part_offsets, place, sorted_parts
from lodestar.sources.extract_files import read_extract, write_extract_files

#: Rows of a file, about; files are named by five digits, so there are never more than these can count.
ROWS_PER_FILE, MOST_FILES = 1_000_000, 99_999
#: Small files are written several to a task: about so many rows and at most so many files. The files of a task
#: are numbered by three digits, which leaves room for a range ten times the planned one.
ROWS_PER_RANGE, FILES_PER_RANGE = 100_000, 100


def _ranges(rows: int, rows_per_file: int, parallel: int) -> int:
    """Ranges to sort: as many as the files or, where files are small, as the rows need and ``parallel`` tasks can use."""
    files = -(-rows // rows_per_file)
    per_range = max(1, min(FILES_PER_RANGE, ROWS_PER_RANGE // rows_per_file))
    return max(1, min(MOST_FILES, files, max(parallel, -(-files // per_range))))


def write_ordered_extract(
    df: DataFrame, path: str, run_id: int, order: Sequence[Column], rows_per_file: int = ROWS_PER_FILE, delimiter: str = ","
) -> None:
    """Write an extract of a run whose files, read in the order of their names, are sorted by ``order``.

    Spark samples the bounds of the ranges and sorts each range in its own task; the number
    of ranges follows from the rows. A range holds one file, or many small ones: what the driver
    gets of every range, samples and results of tasks, does not grow as files get smaller. Rows that are equal in
    ``order`` are dealt by a hash, so one hot value spans several files. A range larger than planned is cut into
    further files, whose names follow each other. An empty table is a single file with the header.
    """
    rows = df.count()
    ranges = _ranges(rows, rows_per_file, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    most = rows_per_file if ranges < -(-rows // rows_per_file) else 2 * rows_per_file
    tie = F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])
    dealt = df.withColumn("__tie", tie).repartitionByRange(ranges, *order, F.col("__tie"))
    dealt = dealt.sortWithinPartitions(*order, "__tie").drop("__tie")
    write_extract_files(dealt, path, run_id, delimiter, maxRecordsPerFile=most)


def read_ordered_extract(spark: SparkSession, path: str, run_id: int, schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """Rows of an ordered extract with their ``position`` in it, from 0."""
    rows = read_extract(spark, path, run_id, schema, delimiter)
    placed = rows.select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__line"),
    )
    parts = sorted_parts(placed, [F.col("__file"), F.col("__block"), F.col("__line")])
    return place(parts, part_offsets(parts, []), []).drop("__file", "__block", "__line", "total")
