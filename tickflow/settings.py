"""Session setup, deployment settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tickflow import schemas

_local_root: str | None = None


@dataclass(frozen=True)
class Settings:
    """Deployment settings; the environment variables keep their usual names."""

    servers: str = field(
        default_factory=lambda: os.environ.get(
            schemas.SERVERS_VARIABLE, schemas.DEFAULT_SERVERS
        )
    )
    alert_length: str = field(
        default_factory=lambda: os.environ.get(
            schemas.ALERT_LENGTH_VARIABLE, schemas.ALERT_LENGTH
        )
    )
    alert_threshold: float = field(
        default_factory=lambda: float(
            os.environ.get(schemas.ALERT_THRESHOLD_VARIABLE, schemas.ALERT_THRESHOLD)
        )
    )
    metrics_group: str | None = field(
        default_factory=lambda: os.environ.get(schemas.METRICS_GROUP_VARIABLE)
    )
    alerts_group: str | None = field(
        default_factory=lambda: os.environ.get(schemas.ALERTS_GROUP_VARIABLE)
    )
    vwap_length: str = schemas.VWAP_LENGTH
    vwap_slide: str = schemas.VWAP_SLIDE
    delay: str = schemas.WATERMARK_DELAY


def build_session(app_name: str = "tickflow", **conf: str) -> SparkSession:
    """A session with the settings the streaming jobs want; ``conf`` overrides them.

    Partition counts are left to the cluster: AQE coalesces batch shuffles, and a
    streaming query keeps the ``spark.sql.shuffle.partitions`` it first ran with.
    """
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    options.update({name.replace("__", "."): value for name, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets one temporary folder; a cluster
    session is refused, because a machine-local folder does not survive a lost host.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tickflow-")
    return _local_root


def checkpoint_path(spark: SparkSession, query: str) -> str:
    """Stable checkpoint location of a named streaming query: restarts resume it."""
    return f"{shared_root(spark)}/tickflow/checkpoints/{query}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for the tables of one run."""
    return f"{shared_root(spark)}/tickflow/runs/{name}-{uuid.uuid4().hex}"
