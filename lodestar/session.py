"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lodestar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the loads rely on.

    Adaptive execution sizes shuffle partitions, splits skewed join partitions and
    replans on measured sizes. On a cluster leave ``master`` out and let
    spark-submit set it, along with ``spark.sql.shuffle.partitions``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at ``spark.checkpoint.dir``.

    The folder must be shared by all executors, so a cluster session has to name
    one. Only a local session without the setting gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="lodestar-checkpoint-")
    sc.setCheckpointDir(folder)


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside leave the disk as each action ends.

    Otherwise they stay until the driver happens to collect its garbage, so a load of several writes
    keeps the shuffles of all of them. Meant for writes, whose rows are read back from the table.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the checkpoint folder and read on from there.

    A columnar table rather than an RDD checkpoint: later steps read only the columns
    and row groups they need, and a lost executor costs no recomputation.
    """
    path = shared_folder(df.sparkSession, "table")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
