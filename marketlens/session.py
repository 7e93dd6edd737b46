"""Session settings and the shared checkpoint folder."""

import os
import re
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # State of streams outgrows the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Page texts are large: bound the Arrow batches by bytes as well as by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def local_session(cores: str = "8", app: str = "marketlens", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MARKETLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCRATCH: dict[str, str] = {}


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The folder all executors see: `folder`, or what the cluster names in spark.checkpoint.dir.

    Only a session on one machine, as in tests, may go without: it gets one scratch folder.
    """
    named = folder or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        _SCRATCH[application] = tempfile.mkdtemp(prefix="marketlens-")
    return _SCRATCH[application]


def with_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Point checkpoint() at the shared folder unless the context already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, folder))
    return spark
