"""Shared pieces of the corpus operators: scans, scratch tables, batch sizes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.session import checkpoint_dir

#: Rows per Arrow batch handed to Python, instead of Spark's 10,000: documents may be megabytes long.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scan of one input table; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for very long texts (a lower setting stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def text_bytes(text: str | Column = "text") -> Column:
    """The UTF-8 bytes of a text; a null text is empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("binary"), F.lit(b""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh table in the shared folder, and a scan of it.

    This cuts the lineage: a lost executor repeats tasks of one step only. The
    folder is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def freed(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once every table made from them is written too: nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Spark drops rows by a Bloom filter of the other side's keys before a shuffle, of inputs from this size on;
#: the other side may be of any size. The filter itself keeps Spark's size, 1 MB.
FILTERED_JOINS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
}


@contextmanager
def filtered_joins(spark: SparkSession) -> Iterator[None]:
    """For a step that fetches few texts of many: its shuffled joins get Spark's runtime filters. Other steps keep their settings."""
    old = {key: spark.conf.get(key) for key in FILTERED_JOINS}
    try:
        for key, value in FILTERED_JOINS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def fresh(base: str, *frames: DataFrame) -> str:
    """A column name that none of ``frames`` uses."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base.lower() in taken:
        base += "_"
    return base
