"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# AQE re-plans joins and splits skewed join partitions at run time, so the
# number of shuffle partitions is only an upper bound here.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, app: str = "lendmark", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", "8")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder is made, but only on a
    local master: on a cluster a machine-local folder is not shared between
    executors, so that case is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_scratch:
        _local_scratch[application] = tempfile.mkdtemp(prefix="lendmark-")
    return _local_scratch[application]
