"""Session construction and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "cohortry", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE on)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs about a millisecond per expression while plans are built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is
    made only in local mode, where the setting may be missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cohortry-")
    spark.sparkContext.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/cohortry/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    input) and gives Catalyst the true size in bytes. A join against the result
    is therefore broadcast only if that measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond it Spark shuffles.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame, *aggs: Column) -> Column:
    """A keyless aggregate as a scalar-subquery struct column.

    Exactly one row by construction, so no join is needed to attach it.
    """
    return df.agg(F.struct(*aggs).alias("s")).scalar()

