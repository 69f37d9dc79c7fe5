"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lamina", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    AQE picks join strategies, splits skewed joins and coalesces partitions at run time, so no
    operator sets a broadcast hint or a partition count of its own for a join or an aggregate.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Input bytes per shuffle partition, and how many partitions a shuffle may have unless the session setting
# ``lamina.shuffle.mostPartitions`` says otherwise: beyond that the number of blocks, which is map tasks times
# partitions, costs more than larger partitions do.
SHUFFLE_BYTES = 128 << 20
MOST_PARTITIONS = 20_000


@cache
def _own_dir() -> str:
    """One folder per driver process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="lamina-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose executor is the driver, may leave it unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _own_dir()
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


# Folders given out in the open ``scratch_scope`` blocks, outermost first.
_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders that were given out in the block when it ends.

    DataFrames made in the block read those folders, so their results have to be stored or collected in it. Without
    a block folders stay until whoever owns the shared folder removes them.
    """
    given: list[str] = []
    _scopes.append(given)
    try:
        yield
    finally:
        _scopes[:] = [scope for scope in _scopes if scope is not given]
        for name in given:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the duration of one write."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins are broadcast by the size that AQE has measured, not by that of files, for the duration of one write.

    A few columns of a compressed file may become many times its size as rows, all of which the driver would hold.
    """
    static, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    most = spark.conf.get(adaptive, None) or spark.conf.get(static)
    with session_setting(spark, adaptive, most), session_setting(spark, static, "-1"):
        yield


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the table's size, 0 where it has none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


@contextmanager
def wide_shuffle(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for an input of this size, never fewer than the session asks for.

    AQE merges partitions that turn out small, but splits only skewed joins, so the number must be
    large enough from the start.
    """
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("lamina.shuffle.mostPartitions", str(MOST_PARTITIONS)))
    wanted = min(most, -(-input_bytes // SHUFFLE_BYTES))
    with session_setting(spark, "spark.sql.shuffle.partitions", str(max(asked, wanted))):
        yield
