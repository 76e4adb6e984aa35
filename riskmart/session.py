"""SparkSession helper.

On a cluster the session is created by the platform; ``get_spark`` only fills in
settings that are unset so it never overrides cluster configuration.  The
checkpoint folder is read from ``spark.checkpoint.dir``; a folder of its own is set
only for a local session without one (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT methods over 8000 bytecode bytes; a fused stage that large is
    # better run as per-operator generated code (split into small methods).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "riskmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RISKMART_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path of the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/riskmart-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, schema: StructType | None = None, session: SparkSession | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, by ``session`` if given (lineage ends there)."""
    spark = session or df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; unset, a local session gets its own and a cluster raises."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="riskmart-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local
