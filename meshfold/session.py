"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on; all of them are session settings.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def local_session(cpus: int = 8, memory: str = "8g", app: str = "meshfold") -> SparkSession:
    """Session for tests and the bench on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to a session somebody else built, and what a pipeline run before may have changed."""
    for key in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy", "spark.sql.requireAllClusterKeysForCoPartition",
                "spark.sql.sources.partitionColumnTypeInference.enabled"):
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder; on a cluster the
    setting is required, since executors would not see a machine-local path.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("meshfold.local.work", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="meshfold-")
        spark.conf.set("meshfold.local.work", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the work root; nothing is created or overwritten."""
    return os.path.join(work_root(spark), f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, for what is read several times: computed once, and each
    reader takes the columns it needs."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives a lost executor)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_root(spark))
    return df.checkpoint(eager=True)
