"""Folders and settings a streaming query needs."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, ``spark.checkpoint.dir``.

    Only a local session may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="sequon-")
    return f"{root.rstrip('/')}/{uuid4().hex}"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Use the RocksDB state store, which user-defined state and timers require.

    A micro-batch then writes what it changed, and the whole state now and then.
    """
    spark.conf.set(_PROVIDER, _ROCKSDB)
    spark.conf.set(_CHANGELOG, "true")
