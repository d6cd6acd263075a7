"""B1 over a file stream: per-bucket counts kept as streaming aggregation state.

Each micro-batch adds its rows' bucket counts to the state store (one row per
bucket, so the state is bounded by the number of buckets, not by the rows).
``complete`` output mode re-emits the whole histogram after each batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.operators.relational import bucketize
from parcelmart.session import checkpoint_dir
from parcelmart.sources.sinks import publish, published


def histogram_stream(spark: SparkSession, path: str, value: str, width=5, max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming histogram of ``value`` over the parquet files under ``path``."""
    schema = spark.read.parquet(path).select(value).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    return bucketize(src, value, width=width, sort=False)


def run_histogram_once(spark: SparkSession, path: str, value: str, width=5, state_dir: str | None = None) -> DataFrame:
    """Process the files that arrived since the last call (``availableNow``), then return the histogram.

    Offsets and aggregation state stay under ``state_dir`` (by default a folder
    of the shared checkpoint folder named by the arguments), so a call resumes
    where the last one, or a failed one, ended. Every micro-batch publishes the
    complete histogram as a new version; readers never see a half-written one.
    """
    if state_dir is None:
        name = hashlib.sha256(repr((path, value, str(width))).encode()).hexdigest()[:16]
        state_dir = f"{checkpoint_dir(spark).rstrip('/')}/stream-histogram-{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, state_dir, "histogram")

    q = (
        histogram_stream(spark, path, value, width)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", f"{state_dir}/state")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return published(spark, state_dir, "histogram").orderBy(F.asc_nulls_last("bucket_floor"))
