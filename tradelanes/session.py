"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tradelanes") -> SparkSession:
    """Session used by tests and the bench; on a cluster the caller builds its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Base folder shared by the driver and all executors, as ``spark.checkpoint.dir`` names it.

    Where the session names none, a local master (one machine, so any local folder
    is shared) gets a folder of its own; any other master gets an error, because a
    machine-local folder would not be seen by the other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tradelanes-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def scratch_base(spark: SparkSession) -> str:
    """This application's own folder under the shared folder."""
    return f"{shared_dir(spark)}/tradelanes-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under this application's scratch folder."""
    return f"{scratch_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str, *folders: str):
    """Write ``df`` as a Parquet table in the scratch folder and read it back: the
    lineage ends there, and later steps get column pruning and statistics.
    ``folders`` are columns whose values get folders of their own."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application left in its scratch folder, once no result needs it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_base(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """A driver table, with its declared schema when it has one (no inference job)."""
    from tradelanes.sources.schemas import DRIVER_TABLE_SCHEMAS

    reader = spark.read
    if name in DRIVER_TABLE_SCHEMAS:
        reader = reader.schema(DRIVER_TABLE_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))
