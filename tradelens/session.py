"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library expects. AQE is what turns the
# per-series statistics joins into broadcast joins at run time (their size is
# measured after the aggregate stage finishes) and splits skewed partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tradelens", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TRADELENS_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is. Only
    when it is unset under a local master (tests) a fresh local folder is
    created and set; any other master without the setting is an error.
    Sessions without a SparkContext (Spark Connect) read the setting from
    the session configuration.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return path.rstrip("/")
    path = sc.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not path:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder")
            path = tempfile.mkdtemp(prefix="tradelens-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path.rstrip("/")


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (keys of per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tradelens/{label}-{uuid.uuid4().hex[:12]}"
