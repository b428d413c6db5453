"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "lakesteps", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, ANSI casts, adaptive plans.

    The number of shuffle partitions is left to the cluster; adaptive execution merges small
    ones and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        raise ValueError(
            f"set {CHECKPOINT_CONF}, when the session is built, to a folder that the driver and all "
            "executors share")
    return path.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application; see ``drop_run_dir``."""
    return f"{shared_dir(spark)}/run-{spark.sparkContext.applicationId}"


def drop_run_dir(spark: SparkSession) -> None:
    """Delete what ``materialize`` has written for this application. Its frames end with it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later passes a columnar input whose
    row values (such as position numbers) can no longer move.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
