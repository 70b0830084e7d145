"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(
    app: str = "cellweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library relies on.

    Nothing here is needed for right results except the UTC time zone, which
    keeps timestamps comparable between engines. Leave ``master`` unset under
    spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cellweave-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, for tools that do not know Spark's default file system."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if default.startswith("file:"):
        return f"file://{os.path.abspath(path)}"
    return f"{default.rstrip('/')}/{path.lstrip('/')}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, for the Python folds.

    Not needed where it is installed on the cluster or passed by ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cellweave-")
    archive = shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
