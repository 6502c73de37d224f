"""Session settings and the shared scratch folder.

The operators never set session configuration themselves; they run in whatever
session they are given.  ``local_session`` is what the tests and ``bench.py``
use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any scale.  Skewed joins are split at run time by AQE,
# so no operator salts an equi-join by hand.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cpus: int = 8, app: str = "shelfmark", memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to the machine's temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.path.join(tempfile.gettempdir(), f"shelfmark-{spark.sparkContext.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read again: one fixed copy without lineage."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def durable(df: DataFrame) -> DataFrame:
    """``df`` written out reliably, so that later stages see one fixed copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))
    return df.checkpoint()
