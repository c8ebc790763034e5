"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

from adlake.sources import files

# Settings the results depend on: dates are derived from UTC instants. ANSI stays on.
RESULT_SETTINGS = {"spark.sql.session.timeZone": "UTC"}

# Settings the plans rely on. AQE sizes shuffles, splits skewed joins and carries out
# REBALANCE, so no shuffle partition count is fixed here: the cluster's value is the
# upper bound and AQE coalesces from it.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session for the batch and streaming jobs; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="adlake-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without the
    setting gets a temporary folder of its own, since on a cluster such a folder would be
    invisible to other machines.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _local_scratch()


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch path whose content is deleted at the end, also after a failure."""
    path = scratch_path(spark, purpose)
    try:
        yield path
    finally:
        files.delete(spark, path)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{scratch_root(spark)}/adlake/{purpose}-{uuid.uuid4().hex}"


_of_session: dict[str, str] = {}


def session_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for what later calls of this session read; deleted when the process ends."""
    application = spark.sparkContext.applicationId
    if application not in _of_session:
        folder = _of_session[application] = scratch_path(spark, "session")
        atexit.register(_delete_at_exit, spark, folder)
    return f"{_of_session[application]}/{purpose}-{uuid.uuid4().hex}"


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    with suppress(Py4JError, OSError):  # the JVM may have ended before
        files.delete(spark, path)
