"""Session builder and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the one you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loanlake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local one would be lost together with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loanlake-"))
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, to the shared folder and read it back.

    Chosen over ``persist`` and ``checkpoint`` because several consumers each
    need a few columns: parquet gives them pruned scans, and losing an executor
    costs a re-read and not a recomputation of the whole plan.
    """
    path = f"{shared_dir(df.sparkSession)}/loanlake/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
