"""Session helpers: building a local session for tests and finding the shared scratch area.

Library code never creates its own session; it receives one. ``build_session`` exists for
tests, ``bench.py`` and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. UTC makes timestamp parsing, bucketing and date casts
# independent of the machine; AQE re-plans joins and shuffle sizes from runtime statistics.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "quarterdeck",
    shuffle_partitions: int = 8,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QD_DRIVER_MEMORY", "16g"))
    )
    for key, value in {**CORE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All rules are defined on UTC timestamps (transaction times arrive as UTC ISO text)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage; every executor and the driver
    see it. Only a local session that does not set it (tests) gets one under the temp folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the SQL conf is visible
        sc = None
    if sc is not None:
        conf_dir = conf_dir or sc.getConf().get("spark.checkpoint.dir", None)
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if sc is None or not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="quarterdeck-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared checkpoint area for one run of one job."""
    return "/".join([checkpoint_root(spark), "quarterdeck", *parts, uuid.uuid4().hex])


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Queries run inside have these session settings; the session's own come back after."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffle_files_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries run inside remove their shuffle files when they end, not when the driver's garbage
    collector finds them."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
