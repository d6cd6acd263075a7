"""Materialisation: CTAS-style writes.

A step result is written once to a fresh folder of the current run and read
back for the steps that use it. That cuts the lineage (a lost executor re-runs
only the step being written) and never overwrites a path that is being read.
``write_clustered`` stores it in buckets of its join key, so that joins on the
key between tables of the same number of buckets shuffle nothing. ``publish``
gives a table a stable name: numbered versions, of which readers take the
newest complete one.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelmart.session import checkpoint_dir

#: Of written tables: a third smaller than by Spark's default.
COMPRESSION = "zstd"


def new_run_dir(spark: SparkSession, base: str | None = None) -> str:
    base = base or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/parcelmart-run-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to ``path`` as parquet and return a scan of what was written."""
    writer = df.write.mode("overwrite").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_clustered(df: DataFrame, path: str, key: str, buckets: int, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` buckets of ``key`` and return a scan that knows them.

    The rows are dealt by the key first, so each bucket is one file (of each
    partition value). The table's entry lives in the session's catalog under a
    fresh name; the files can be read without it.
    """
    spark, name = df.sparkSession, f"parcelmart_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("compression", COMPRESSION).option("path", path).bucketBy(buckets, key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name)


def publish(df: DataFrame, base: str, name: str, keep: int = 2, key: str | None = None, buckets: int = 0) -> DataFrame:
    """Write ``df`` as the newest version of the table ``name`` under ``base`` and return it.

    Readers take the newest complete version (``published``), so they see the
    old rows until the write has committed and the new ones from then on. The
    newest ``keep`` versions stay, for readers that have begun on one; older
    ones are removed after the switch. Publishers that run at once write to
    folders of their own, and of the same number the one whose name sorts last
    is read by all. With ``key``, the version is stored clustered by it.
    """
    spark, folder = df.sparkSession, f"{base.rstrip('/')}/{name}"
    number = max((_number(v) for v in _versions(spark, folder, complete=False)), default=0) + 1
    path = f"{folder}/v{number:06d}-{uuid.uuid4().hex[:8]}"
    if key:
        out = write_clustered(df, path, key, buckets)
    else:
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    for old in _versions(spark, folder)[:-keep]:
        fs, place = _place(spark, f"{folder}/{old}")
        fs.delete(place, True)
    return out


def published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The newest complete version of a published table."""
    folder = f"{base.rstrip('/')}/{name}"
    versions = _versions(spark, folder)
    if not versions:
        raise LookupError(f"nothing is published as {name} under {base}")
    return spark.read.parquet(f"{folder}/{versions[-1]}")


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _number(version: str) -> int:
    return int(version[1:7])


def _versions(spark: SparkSession, folder: str, complete: bool = True) -> list[str]:
    """Names of the versions in ``folder``, ascending; ``complete``: those whose write has committed."""
    fs, place = _place(spark, folder)
    if not fs.exists(place):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(place)]
    names = sorted(n for n in names if re.fullmatch(r"v\d{6}-[0-9a-f]{8}", n))
    return [n for n in names if not complete or fs.exists(_place(spark, f"{folder}/{n}/_SUCCESS")[1])]
