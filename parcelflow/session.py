"""Sessions and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites are not recorded for every column, which speeds up plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# State partitions are fixed for the life of a checkpoint, so no adaptive plans here.
STREAM_CONF = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.minBatchesToRetain": "5",
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def build_session(
    name: str = "parcelflow",
    streaming: bool = False,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for batch or streaming work. Cluster settings win over none given here."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    conf = COMMON_CONF | (STREAM_CONF if streaming else BATCH_CONF) | (extra or {})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]):
    """Set SQL settings for a block and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = os.path.join(tempfile.gettempdir(), "parcelflow-" + uuid.uuid4().hex[:8])
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_scratch(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder for one run."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
