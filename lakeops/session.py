"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app_name: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its time zone."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` where the cluster names one.

    Without it only a local session gets a temporary folder; a cluster without a shared folder is refused,
    because files written to one machine's disk are lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or ""
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="lakeops-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
