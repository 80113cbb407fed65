"""Session settings and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent

# Contexts that have the package already.
_shipped: set[str] = set()


def start(app: str = "lexitally", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators count on; `conf` keys use __ for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Hand this package's source to every executor of the session, once: for operators that run
    Python there. The archive is a few kilobytes; the driver serves it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(PACKAGE.rglob("*.py")):
            z.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """`df` dealt to so many tasks, or as it is without a number. Only for an input that is known
    to be stored in fewer pieces than there are cores: it moves every row."""
    if tasks is None:
        return df
    if tasks < 1:
        raise ValueError("tasks must be at least 1")
    return df.repartition(tasks)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees: `spark.checkpoint.dir`. Only where that is unset and the
    master is this one machine, as in tests, one below /tmp/checkpoints is taken for the context."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"/tmp/checkpoints/{uuid.uuid4().hex}"
    context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
