"""Load control kept as data: watermarks, job log and message log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.functions.columns import ts_lit

WATERMARK_SCHEMA = "fact_name string, subsidiary_id string, ext_start_dt timestamp_ntz, ext_end_dt timestamp_ntz"
JOB_LOG_SCHEMA = (
    "job_id bigint, runid int, entity string, run_mode string, job_status string, subsidiary_id string, "
    "extractstart timestamp_ntz, extractend timestamp_ntz, loadstart timestamp_ntz, loadend timestamp_ntz"
)
MESSAGE_LOG_SCHEMA = (
    "runid int, message_desc string, target_table string, message_stage string, message_type string, "
    "message_timestamp timestamp_ntz, subsidiary_id string"
)

# Status texts of the job log.
IN_PROGRESS, SUCCESS, ERROR = "In Progress", "Success", "Error"


class MissingWatermark(LookupError):
    """A fact was asked for that has no watermark entry."""


def watermark_read(watermarks: DataFrame, fact: str | None = None, subsidiary: str | None = None) -> DataFrame:
    """End of the last extract per fact and subsidiary, optionally of one only."""
    out = watermarks
    if fact is not None:
        out = out.filter(F.col("fact_name") == fact)
    if subsidiary is not None:
        out = out.filter(F.col("subsidiary_id") == subsidiary)
    return out.select("fact_name", "subsidiary_id", F.col("ext_end_dt").alias("watermark"))


def watermark_value(watermarks: DataFrame, fact: str, subsidiary: str) -> dt.datetime:
    """The one watermark an extract starts from; its absence is an error."""
    row = watermark_read(watermarks, fact, subsidiary).first()
    if row is None:
        raise MissingWatermark(f"no watermark for {fact} / {subsidiary}")
    return row["watermark"]


def watermark_advance(
    watermarks: DataFrame, fact: str | Column, subsidiary: str | Column, start: str | dt.datetime, end: str | dt.datetime
) -> DataFrame:
    """Watermarks with the extract interval of one fact and subsidiary replaced.

    Take ``end`` before the read: rows modified meanwhile then come again and the
    diff drops them. Publish only after the fact load is in place.
    """
    hit = (F.col("fact_name") == fact) & (F.col("subsidiary_id") == subsidiary)
    return watermarks.withColumns(
        {
            "ext_start_dt": F.when(hit, ts_lit(start)).otherwise(F.col("ext_start_dt")),
            "ext_end_dt": F.when(hit, ts_lit(end)).otherwise(F.col("ext_end_dt")),
        }
    )


def next_run_id(job_log: DataFrame) -> int:
    """One above the highest run id logged so far."""
    return int(job_log.agg(F.coalesce(F.max("runid"), F.lit(0))).first()[0]) + 1


def job_rows(spark: SparkSession, rows: Iterable[Mapping[str, object]]) -> DataFrame:
    """Job log rows, one per entity of a run."""
    names = [f.split()[0] for f in JOB_LOG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], JOB_LOG_SCHEMA)


def final_status(job_log: DataFrame) -> DataFrame:
    """Close the log of a run: whatever did not fail succeeded."""
    return job_log.withColumn(
        "job_status", F.when(F.col("job_status") == ERROR, F.lit(ERROR)).otherwise(F.lit(SUCCESS))
    )


def failed_jobs(job_log: DataFrame, run_id: int | None = None) -> DataFrame:
    """Number of failed jobs per run; a clean run shows 0."""
    log = job_log if run_id is None else job_log.filter(F.col("runid") == run_id)
    return log.groupBy("runid").agg(F.count(F.when(F.col("job_status") == ERROR, True)).alias("failed"))


def message_rows(counts: DataFrame, run_id: int, table: str, subsidiary: str, run_ts: str | dt.datetime) -> DataFrame:
    """Message log rows out of a one-row frame of counts, one per count column."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).cast("string").alias("n")) for c in counts.columns])
    )
    return counts.select(pairs.alias("m")).select(
        F.lit(run_id).alias("runid"),
        F.concat(F.lit("no of records "), F.col("m.stage"), F.lit(" --> "), F.col("m.n")).alias("message_desc"),
        F.lit(table).alias("target_table"),
        F.col("m.stage").alias("message_stage"),
        F.lit("Info").alias("message_type"),
        ts_lit(run_ts).alias("message_timestamp"),
        F.lit(subsidiary).alias("subsidiary_id"),
    )
