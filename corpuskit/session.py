"""Session helpers: the builder used by tests and the bench, table loading, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the operators assume (UTC, AQE, last-wins maps)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpuskit")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``. Where none is set, a local session (tests) has a temporary one;
    a cluster has no folder that all its machines see, so this fails."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "corpuskit-checkpoints"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: the rows are written to the shared folder and read back from there. With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark removes it once nothing refers to it any more."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for tables that a query writes itself."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, bytes_per_task: int = 2 << 20) -> DataFrame:
    """Rows for work that is heavy for their size (Python passes): a small input of fewer files than there are cores is
    spread over all cores, its texts included. Other inputs are left as the scan splits them, and nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * bytes_per_task and len(df.inputFiles()) < cores else df
