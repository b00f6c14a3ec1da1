"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Pages can be large, so Arrow batches are bounded by bytes.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    "spark.sql.parquet.compression.codec": "zstd",
    # plans are built from many small expressions, the call sites of which nobody looks up
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "pressloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` overrides them (dots as `__`)."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pressloom-"), "pressloom")
    shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(f"{archive}.zip")
    _shipped.add(app)


def bound_batches(spark: SparkSession, rows: int) -> None:
    """Bound the rows of the Arrow batches that Python workers get, unless a smaller bound is set."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= rows:
        spark.conf.set(setting, str(rows))


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on a local disk that all executors reach, or None for any other file system."""
    if path.startswith("file:///"):
        return path.removeprefix("file://")
    return path if path.startswith("/") and spark.sparkContext.master.startswith("local") else None


_local_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`, which every executor can reach.

    Local mode has a single machine, so there an unset folder falls back to a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        root = _local_roots.get(app) or _local_roots.setdefault(app, tempfile.mkdtemp(prefix="pressloom-"))
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")
