"""Session settings, and the shared folder that scratch tables go to."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every job of this package relies on or profits from.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # 7 days of event ids do not fit an executor heap: keep state in RocksDB
    # and upload only the changes of each batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Call-site capture for error messages; it makes building wide plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "orderlake",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session. Leave ``master`` unset under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(SESSION_SETTINGS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share.

    That is ``spark.checkpoint.dir``; where it is unset, the warehouse folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/orderlake/{name}-{uuid.uuid4().hex}"


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Set session options for the body only, then put the old ones back.

    A streaming query copies the session when it starts, so options set around
    ``start()`` hold for the whole life of that query.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
