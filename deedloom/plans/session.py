"""Session settings that the operators assume."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold at any size; sizes of partitions are left to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str = "deedloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    for key, value in {**DEFAULTS, "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; one of our own only on a local master (tests), where executors share the machine.

    A cluster without spark.checkpoint.dir is an error: no folder of the driver's machine could be read by its executors.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.match(r"local(?:\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="deedloom-checkpoint-", dir=os.environ.get("TMPDIR"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage through a reliable checkpoint, which survives lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager)
