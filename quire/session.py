"""Session defaults and the two settings every operator relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "quire", cpus: int | None = None) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{n}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """A plain scan over as many partitions as there are cores.

    Small tables often lie in one file with one row group, which is one task.
    Only a scan of under ``SPREAD_BYTES`` with too few partitions is shuffled;
    a larger one is left as Spark splits it (spark.sql.files.maxPartitionBytes).
    What has been shuffled already stays as it is: to ask for its partitions
    would run the shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    shuffled = df._jdf.queryExecution().executedPlan().getClass().getSimpleName() == "AdaptiveSparkPlanExec"
    if shuffled or df.rdd.getNumPartitions() * 2 > cores:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df if int(str(size)) >= SPREAD_BYTES else df.repartition(cores)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster.  Where none is set a local session
    gets a folder of its own; a cluster must name one."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quire-checkpoint-")
    if not known.isDefined():
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut through the reliable checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table written to the checkpoint folder: computed once,
    read by any number of later steps, and safe from lost executors."""
    folder = f"{checkpoint_dir(df.sparkSession)}/quire-{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
