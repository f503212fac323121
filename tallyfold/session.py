"""Session settings for the jobs."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: HotSpot never compiles a method of more bytes; Spark's own limit is 65535.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "65535", "8000")


def package_archive(folder: str) -> str:
    """A zip of this package's source in ``folder``."""
    root = Path(__file__).resolve().parent
    archive = os.path.join(folder, "tallyfold_source.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    return archive


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application: Python functions in a plan name it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    context.addPyFile(package_archive(tempfile.mkdtemp(prefix="tallyfold-ship-")))
    _shipped.add(context.applicationId)


def compile_wide_rows(spark: SparkSession) -> None:
    """Generated methods that HotSpot would only interpret are left to Spark's projections, which cut them up.

    The rows of a respondent, with 81 weights and 21 metrics, make such methods. A limit that somebody has set is kept.
    """
    key, usual, limit = METHOD_LIMIT
    if spark.conf.get(key, usual) == usual:
        spark.conf.set(key, limit)


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session for the jobs; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        # 81 weights make 162 sums, which are to stay in generated code
        "spark.sql.codegen.maxFields": "400",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    compile_wide_rows(spark)
    ship_package(spark)
    return spark
