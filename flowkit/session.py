"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Window state in RocksDB: it may outgrow the memory of an executor, and only there can it have timers.
_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "flowkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``conf`` keys use ``__`` for the dots of a Spark setting, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        # As in Python, the last of equal keys of a JSON object counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config(map=_STATE)
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, so window bounds never depend on where Spark runs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, whatever the session says; it has its settings back after.

    A stream takes its settings when it starts, and on a restart the state
    store from its checkpoint.
    """
    before = {key: spark.conf.get(key, None) for key in _STATE}
    try:
        for key, value in _STATE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key)
            if spark.conf.get(key, None) != value:
                spark.conf.set(key, value)


#: Folders handed out by ``scratch_dir``, by the application that asked.
_HANDED_OUT: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name that every executor can reach.

    It lies in the folder ``spark.checkpoint.dir`` names, else in a folder
    ``scratch`` of the warehouse. On a cluster one of the two has to be set:
    the warehouse that Spark takes by default is a folder of the driver.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        own = warehouse.removeprefix("file:").replace("//", "/") == f"{os.getcwd()}/spark-warehouse"
        if own and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = f"{warehouse}/scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this application; frames read from them end here.

    Returns how many there were.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    dropped = 0
    for path in _HANDED_OUT.pop(spark.sparkContext.applicationId, []):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        dropped += bool(folder.getFileSystem(conf).delete(folder, True))
    return dropped


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a point that survives lost executors, keeps a frame
    used twice from being computed twice, and gives Catalyst the true size, so
    it broadcasts the frame in a join only when that size is under
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
