"""Session settings the package is written for."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# ANSI stays on (Spark's default): lenient casts are explicit. Adaptive execution sizes
# shuffle partitions, splits skewed joins, and broadcasts a side only under the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # HotSpot does not compile methods over 8000 bytes. The wide cleaning projections would
    # pass that as one generated method; above the limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def builder(app: str = "gondola") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for this run's intermediate tables, on the shared storage the cluster
    names in ``spark.checkpoint.dir``. Unset, it is an error except on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="gondola-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is done, not with the next collection of the driver's heap."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_shipped: set[tuple[str, str]] = set()


def ship_package(spark: SparkSession, *folders: str) -> None:
    """Makes this package, and other package folders given, importable in Python workers.

    The archive and page readers need it. Each folder is shipped once per application.
    """
    app = spark.sparkContext.applicationId
    for package in [Path(__file__).resolve().parent, *map(Path, folders)]:
        if (app, str(package)) not in _shipped:
            target = Path(tempfile.mkdtemp(prefix="gondola-package-")) / package.name
            spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
            _shipped.add((app, str(package)))
