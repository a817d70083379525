"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "loanlens") -> SparkSession:
    """Local session for tests and the bench; on a cluster the caller brings the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # The JVM does not compile methods above 8000 bytes; wide projections run three times
        # faster when Spark splits them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def split_wide_methods(spark: SparkSession) -> None:
    """Lets Spark split generated methods that the JVM would not compile, in sessions that do not yet."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > 8000:
        spark.conf.set(key, "8000")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local-mode session without the setting (a test) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _test_folder(spark.sparkContext.applicationId)


@lru_cache
def _test_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"loanlens-{application}-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str):
    """Write a DataFrame once and continue from the written table.

    The table outlives lost executors and cuts the lineage; later readers do not repeat the
    work behind it.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
