"""Spark session with the settings that the engine expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",  # posting files in GB 18030
}


def session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``CONF``; further settings may be given with ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (CONF | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """``spark`` with a checkpoint folder: the shared one that the cluster names, or a temporary one in local mode."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="larkspur-"))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that all machines share, for what Spark writes and reads back."""
    root = spark.conf.get("spark.checkpoint.dir", None) or with_checkpoints(spark).sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and all that the optimizer has derived from it.

    In loops a ``checkpoint`` is no substitute: the constraints of its plan stay and multiply with each join.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def all_tasks(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt to as many tasks as a shuffle has, by columns if any are named; by their bytes few rows that take long, or many that compress well, would be one task's."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
