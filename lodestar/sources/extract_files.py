"""Extract files: delimited text with a header, one folder per entity and run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodestar.functions.reserved import TEXT_TIMESTAMP
from lodestar.operators.extract import stamp_run_id

CORRUPT = "_corrupt_record"


def _options(delimiter: str) -> dict[str, object]:
    # An empty field is NULL, a quoted empty field is the empty string; quotes inside
    # a value are doubled.
    return {
        "header": True,
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        "nullValue": "",
        "emptyValue": '""',
        "timestampFormat": TEXT_TIMESTAMP,
        "timestampNTZFormat": TEXT_TIMESTAMP,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def pack_text(c: Column) -> Column:
    """Text on one line: a line feed becomes ``\\n``, a carriage return ``\\r``, a backslash ``\\s``."""
    out = F.replace(c, F.lit("\\"), F.lit("\\s"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unpack_text(c: Column) -> Column:
    """Undo :func:`pack_text`."""
    out = F.replace(F.replace(c, F.lit("\\r"), F.lit("\r")), F.lit("\\n"), F.lit("\n"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def _each_text(df: DataFrame, change: Callable[[Column], Column], names: Sequence[str] | None = None) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (names is None or f.name in names)]
    return df.withColumns({c: change(F.col(c)) for c in texts}) if texts else df


def write_extract(df: DataFrame, path: str, run_id: int, delimiter: str = ",") -> None:
    """Write an extract under ``path/runid=<run_id>``, replacing an earlier try of that run.

    Every row is one line whatever its texts hold (see :func:`pack_text`), so large files
    can be split among tasks.
    """
    write_extract_files(df, path, run_id, delimiter)


def write_extract_files(df: DataFrame, path: str, run_id: int, delimiter: str = ",", **options: object) -> None:
    """:func:`write_extract` with further options of the writer; rows stay in the partitions and order of ``df``."""
    stamped = stamp_run_id(_each_text(df, pack_text), run_id)
    stamped.write.mode("overwrite").options(**_options(delimiter), **options).csv(f"{path}/runid={run_id}")


def read_extract(
    spark: SparkSession, path: str, run_id: int, schema: T.StructType, delimiter: str = ",", packed: bool = True
) -> DataFrame:
    """Read the extract of one run, typed by ``schema`` (without the run id).

    A line that does not fit keeps what could be read and goes whole to the corrupt
    column. Set ``packed`` to False for files of another writer, whose backslashes stand
    for themselves; a raw line break inside a value is not supported there.
    """
    full = T.StructType([T.StructField("runid", T.IntegerType()), *schema.fields, T.StructField(CORRUPT, T.StringType())])
    # The reader hands out ``nullValue`` for an empty field and compares with it, so it
    # has to be a text no field can hold; a quoted empty field then stays ''.
    options = {**_options(delimiter), "emptyValue": "", "nullValue": "\u0000", "mode": "PERMISSIVE"}
    rows = spark.read.schema(full).options(columnNameOfCorruptRecord=CORRUPT, **options).csv(f"{path}/runid={run_id}")
    return _each_text(rows, unpack_text, schema.names) if packed else rows


def rejected_lines(extract: DataFrame) -> DataFrame:
    """Lines of an extract that did not fit its schema."""
    return extract.filter(F.col(CORRUPT).isNotNull())


def latest_run(df: DataFrame, run_column: str = "runid") -> DataFrame:
    """Rows of the highest run id in a table partitioned by run."""
    newest = df.agg(F.max(run_column)).scalar()
    return df.filter(F.col(run_column) == newest)


def latest_file(spark: SparkSession, path: str, prefix: str = "") -> str | None:
    """The newest of the files below ``path`` whose relative name begins with ``prefix``; None without any.

    The time of modification decides, then the name. ``prefix`` may reach into folders
    (``2026/customers_``). Files are listed by Spark and not opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = files.load(f"{path}/{prefix}*")
    except AnalysisException:
        return None  # nothing has such a name
    newest = found.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).first()
    return None if newest is None else newest["path"]


def reference_file(spark: SparkSession, path: str, run_id: int, delimiter: str = ",") -> DataFrame:
    """A flat reference file with a header, all text, with the run id in front."""
    return stamp_run_id(spark.read.options(header=True, sep=delimiter, quote='"', escape='"').csv(path), run_id)
