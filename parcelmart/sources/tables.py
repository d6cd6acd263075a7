"""Scans of the provided parquet tables.

Each table is one parquet path ``<dir>/<name>.parquet``. Scans are lazy: a
query that needs two columns reads two columns, and filters reach the parquet
reader as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table as it is now; the alias lets joins qualify columns as ``name.col``."""
    return spark.read.parquet(table_path(sf_dir, name)).alias(name)


def listing(spark: SparkSession, sf_dir: str, names) -> tuple:
    """The files of some tables (path, bytes, time of change): what a result made from them depends on."""
    jvm, out = spark.sparkContext._jvm, []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def register_views(spark: SparkSession, sf_dir: str, names=TABLE_NAMES, prefix: str = "") -> None:
    """Register the tables as temp views for ``spark.sql``.

    ``spark.sql`` analyses its text when called, so a DataFrame built from these
    views keeps pointing at this ``sf_dir`` even if the views are replaced later.
    """
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
