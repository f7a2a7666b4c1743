"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where the split costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that only a new session takes.
STATIC_CONF = {
    # Column expressions are built without recording a Python stack trace each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "statledger", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session with the library's settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable options on a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or, where that is unset, one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return os.path.join(shared_dir(spark), "statledger", f"{label}-{uuid.uuid4().hex}")


def ship_by_value(module_name: str) -> None:
    """Send a module's functions to Python workers as code, so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
