"""Session settings and the shared scratch location.

The engine is written for a cluster: scratch data (landed test pages, staged
tables, checkpoints) always goes below ``spark.checkpoint.dir``, the folder the
cluster shares between executors.  Only when that setting is unset (local runs,
tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session defaults the engine relies on.  UTC matters for the report's text
# timestamps; AQE re-plans joins from runtime sizes and splits skewed
# partitions (a hot userId or a null-heavy objectId).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Broadcast only what is proven small: explicit hints after a row count
    # (operators.joins), or AQE's decision from the MEASURED size of a
    # finished shuffle stage -- never the planner's file-size estimate.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "logloom", extra: dict | None = None) -> SparkSession:
    """The engine's session.

    On a cluster (no ``master`` given, e.g. under ``spark-submit``) sizing is
    left to the cluster's configuration: shuffle partitions, memory and the
    shared ``spark.checkpoint.dir`` come from there, and AQE coalesces small
    shuffle partitions at run time.  Only local runs (tests, bench) get a
    shuffle width equal to their cores and a fixed driver memory.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(ENGINE_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Checkpoints written by row numbering are removed once unreferenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    })
    local = bool(master) and master.startswith("local")
    if master:
        builder = builder.master(master)
    if local:
        cores = master[len("local["):-1] if master.startswith("local[") else "1"
        width = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
        conf["spark.sql.shuffle.partitions"] = str(width)
        conf["spark.driver.memory"] = os.environ.get("LOGLOOM_DRIVER_MEMORY", "8g")
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the engine depends on (idempotent)."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


@contextmanager
def sql_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime SQL settings for what is planned and run inside the block alone."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).

    Only a local master gets a folder of its own where none is named (tests,
    bench).  On a cluster a machine-local folder would be seen by one machine
    alone, so there the setting is required.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- no classic context: the setting is all there is
        if not current:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return current
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if not current:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="logloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    sc.setCheckpointDir(current)
    return sc._jsc.sc().getCheckpointDir().get()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/logloom/{name}-{uuid.uuid4().hex[:12]}"
