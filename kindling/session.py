"""Session factory and the shared scratch / checkpoint folder.

On a cluster the operator library never picks a folder itself: it reads
``spark.checkpoint.dir`` (the shared folder the cluster names) and puts
checkpoints, stream checkpoints and staged tables below it. Only when the
setting is absent (tests, a laptop) does it create a private temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_SHIPPED: set[str] = set()


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "kindling",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and no web UI."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # Unset: tests and single-machine runs only. A cluster names its own.
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="kindling-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/kindling-scratch/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks
    can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="kindling-code-"), "kindling.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("kindling", os.path.relpath(full, here)))
    sc.addPyFile(path)
