"""Session settings and durable materialisation shared by all operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  All of them are ordinary Spark options; a
# cluster may override any of them in spark-defaults.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

def build_session(app: str = "forumlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, in local mode else the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path under the shared folder (one per call, never reused)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage like a reliable checkpoint, survives the loss of any executor,
    and unlike a row checkpoint keeps column pruning and real size statistics, so later
    joins can be re-planned from the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
