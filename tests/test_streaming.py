"""The streamed histogram equals the batch histogram over the same files."""

import shutil

from parcelmart.operators import bucketize
from parcelmart.streaming import run_histogram_once
from tests.conftest import SF_SMALL


def test_stream_histogram_matches_batch(spark, tmp_path):
    folder = tmp_path / "arrivals"
    folder.mkdir()
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", folder / "part-0.parquet")
    streamed = [tuple(r) for r in run_histogram_once(spark, str(folder), "l_extendedprice", 5).collect()]
    batch = [tuple(r) for r in bucketize(spark.read.parquet(str(folder)), "l_extendedprice", 5).collect()]
    assert streamed == batch and len(batch) > 100


def test_stream_resumes_with_new_files_only(spark, tmp_path):
    folder, state = tmp_path / "more", str(tmp_path / "state")
    folder.mkdir()
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", folder / "part-0.parquet")
    first = run_histogram_once(spark, str(folder), "l_quantity", 5, state_dir=state)
    before = {r.bucket_floor: r["count"] for r in first.collect()}
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", folder / "part-1.parquet")
    after = {r.bucket_floor: r["count"] for r in run_histogram_once(spark, str(folder), "l_quantity", 5, state_dir=state).collect()}
    assert after == {k: 2 * n for k, n in before.items()}
