"""Session settings the library relies on.

The library never creates a session inside an operator; callers pass one in.
``configure`` applies the few settings whose values change results (UTC, string
partition columns) and the scale settings (AQE, skew splitting). ``local_session``
is for tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that change results: keep timestamps in UTC and keep partition values
# such as month='01' as strings.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings for large inputs: adaptive re-planning, partition coalescing, runtime
# skew splitting for sort-merge joins, and broadcast decided by measured size. A
# task that writes folders of a partition column keeps this many files open, and
# sorts (and spills) only the rows of further folders; each holds a row group.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# Shuffle partitions that AQE starts from on a cluster and then merges: it never
# splits one that is too coarse. 100 TB need some hundred thousand.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in {**RESULT_SETTINGS, **SCALE_SETTINGS}.items():
        spark.conf.set(key, value)
    if initial_partitions:
        spark.conf.set(INITIAL_PARTITIONS, str(initial_partitions))
    return spark


# The scratch folder of a local application that names none, by application id.
_LOCAL_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables, from ``spark.checkpoint.dir``.

    Where it is unset, a session in one local process (tests, bench) gets a
    scratch folder, the same one until the application ends. Any other session
    fails without it: executors do not share this machine's folders. A ``file:``
    path is taken to be a mount that they do share.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    if not re.match(r"local($|\[)", spark.conf.get("spark.master", "")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="parcelmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _LOCAL_SCRATCH[app]


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Make a folder for intermediate tables, and have it removed when the application ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(place)  # a folder that is not there yet would not be remembered
    fs.deleteOnExit(place)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "parcelmart") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PARCELMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Small local test files: do not pack several into one scan task.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
    )
    for key, value in {**RESULT_SETTINGS, **SCALE_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
