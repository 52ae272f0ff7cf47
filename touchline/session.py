"""Session settings the jobs are designed for, and their scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. No join is hinted: Spark
# broadcasts a side only below its size threshold and splits hot partitions of
# the shuffled joins beyond it, also where that costs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.session.timeZone": "UTC",
}

# Settings for a session of our own. Capturing the call site of every column
# expression costs several round trips each while a plan is built.
BUILD_CONF = {
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or get) a session with the settings above and no web page."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for intermediate tables, on storage all executors share.

    It lies under ``spark.checkpoint.dir``. Only a local session, whose
    executors share the machine, may do without that setting; its folders go with
    the process. Folders on shared storage stay until their owner drops them.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/touchline-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="touchline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
