"""Session settings and the shared scratch folder used by jobs that write."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Folders handed out by this process and not yet removed.
_handed_out: list[str] = []

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # year=/month=/dt= are strings with leading zeros; inference would turn them into ints.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # Wide projections (dozens of parsed columns) make methods the JVM never compiles; beyond this
    # size Spark splits them into small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "pricelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def split_wide_methods(spark: SparkSession) -> None:
    """The last of these settings for a session built elsewhere: it can be set at any time and holds for plans run from then on."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > int(DEFAULT_CONF[limit]):
        spark.conf.set(limit, DEFAULT_CONF[limit])


#: Shuffle files of a query go when it has run.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files when they end. Otherwise these stay until the driver happens to collect its garbage,
    so a load would hold those of all its steps. For writes, which nothing reads again but through what they wrote."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@cache
def _own_dir() -> str:
    """Folder of a session that names none; it goes when the process ends."""
    path = tempfile.mkdtemp(prefix="pricelake-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder the cluster names.

    A local master without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_dir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder; two runs never meet in one. ``discard`` or ``release`` removes it."""
    path = f"{shared_dir(spark)}/pricelake/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove work folders that nothing reads any more, in whatever store holds them."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in _handed_out:
            _handed_out.remove(path)


def release(spark: SparkSession) -> None:
    """Remove every work folder handed out so far, once the frames that read them are done with."""
    discard(spark, *list(_handed_out))
