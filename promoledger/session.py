"""Session defaults and the shared folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # No call-site capture per column expression: plans here are built from many small ones.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "promoledger", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A private temporary folder is used only by a local master that names none.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="promoledger-")
    return _local_folders[application]


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/promoledger/{label}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here give their shuffle files back when they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder and read it back.

    The written table cuts the lineage and outlives any lost executor, so what
    follows (counting, overwriting the very table ``df`` was read from) neither
    recomputes nor races with its own input. Nothing reads the shuffles of the
    write again, so a job in several stages needs the disk of the largest, not of all.
    """
    spark = df.sparkSession
    path = new_work_path(spark, label)
    with freed_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
