"""What the plans promise at scale: shuffles of the cube, hot codes, many versions, pruning, publishing."""

import datetime as dt
import os
import random
import re
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from parcelmart.functions.scalar import elapsed_seconds
from parcelmart.operators.hot_keys import hot_key_join, hot_values
from parcelmart.operators.intervals import interval_join, with_valid_counts
from parcelmart.plans import catalog, mart, runner
from parcelmart.plans.catalog import PARAMS, QUERIES
from parcelmart.session import checkpoint_dir
from parcelmart.sources.sinks import publish, published, write_clustered, write_table
from parcelmart.sources.standins import standin_tables
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# --- clustered steps --------------------------------------------------------------------


def test_joins_on_the_code_shuffle_nothing(spark, no_broadcast):
    plan = plan_of(QUERIES["metrics_cube"](spark, SF_SMALL))
    assert plan.count("Arguments: hashpartitioning") == 1  # the aggregation
    assert plan.count("SortMergeJoin") >= 8
    assert plan_of(QUERIES["distinct_counts"](spark, SF_SMALL)).count("Arguments: hashpartitioning") == 1


def test_clustered_table_keeps_rows_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "x"), ("b", None, "y"), ("a", 1, "x")], "k string, v int, part string")
    out = write_clustered(df, str(tmp_path / "t"), "k", 4, ["part"])
    assert rows_of(out.select("k", "v", "part")) == rows_of(df)
    assert rows_of(spark.read.parquet(str(tmp_path / "t")).select("k", "v", "part")) == rows_of(df)
    files = [f for _, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert len(files) <= 8


def test_written_tables_are_compressed_well(spark, tmp_path):
    write_clustered(spark.range(100).withColumn("k", F.col("id") % 7), str(tmp_path / "c"), "k", 2)
    write_table(spark.range(100), str(tmp_path / "t"))
    for folder in ("c", "t"):
        files = [f for _, _, names in os.walk(tmp_path / folder) for f in names if f.endswith(".parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_folders_are_written_without_a_sort(spark, tmp_path):
    df = spark.range(90).selectExpr("id AS v", "CAST(2011 + id % 9 AS STRING) AS year")
    df.limit(0).write.partitionBy("year").option("path", str(tmp_path / "t")).saveAsTable("by_year")
    try:
        df.createOrReplaceTempView("rows_by_year")
        plan = spark.sql("EXPLAIN INSERT INTO by_year PARTITION (year) SELECT v, year FROM rows_by_year").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE by_year")
        spark.catalog.dropTempView("rows_by_year")
    # Nine folders of one task, more than the files that it keeps open: all rows come back.
    assert rows_of(write_table(df.coalesce(1), str(tmp_path / "u"), ["year"]).select("v", "year")) == rows_of(df)


def test_facts_join_validity_steps_of_known_size(spark):
    facts = catalog._mart_outputs(spark, SF_SMALL, "booking_facts")[1]["booking_facts"]
    plan = plan_of(facts)
    # The steps are a written table, small by its size: the bookings stay where they are until their code deals them.
    assert "/aside" in plan and "Arguments: hashpartitioning" not in plan and "polygon_boundaries" not in plan


# --- hot codes --------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_join_equals_the_plain_join(spark, how):
    rng = random.Random(4)
    left = [(i, "hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{rng.randrange(60)}") for i in range(3000)]
    right = [("hot", 1), ("hot", 1), ("hot", 2), (None, 3), *[(f"k{i}", i) for i in range(40)], ("", 5)]
    a, b = spark.createDataFrame(left, "id int, code string"), spark.createDataFrame(right, "rcode string, v int")
    plain = a.join(b, F.col("code") == F.col("rcode"), how)
    assert hot_values(a, "code", 0.2) == ["hot"] and hot_values(a.where("false"), "code") == []
    got = hot_key_join(a, b, ("code", "rcode"), "id", how, hot=["hot"])
    assert got.columns == plain.columns
    # The right rows' key is the plain one again only in left columns; compare those and the value.
    columns = [c for c in plain.columns if c != "rcode"]
    assert rows_of(got.select(*columns)) == rows_of(plain.select(*columns))
    assert rows_of(hot_key_join(a, b, ("code", "rcode"), "id", how, hot=[]).select(*columns)) == rows_of(plain.select(*columns))
    with pytest.raises(ValueError):
        hot_key_join(a, b, ("code", "rcode"), "id", "right")


def test_hot_key_join_spreads_the_hot_rows(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        left = spark.range(60_000).withColumn("code", code)
        right = left.select(F.col("code").alias("rcode")).distinct().withColumn("v", F.length("rcode"))
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        plain = sizes(left.join(right, F.col("code") == F.col("rcode")))
        spread = sizes(hot_key_join(left, right, ("code", "rcode"), "id", "inner"))
        assert plain[-1] > 4 * plain[len(plain) // 2]
        assert sum(spread) == sum(plain) == 60_000 and spread[-1] <= 3 * spread[len(spread) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_pairs_keep_their_partitions(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("code"))
    right = left.select(F.col("code").alias("rcode"), (F.col("id") * 3).alias("v")).where("v % 2 = 0")
    got = hot_key_join(left, right, ("code", "rcode"), "id", "inner", hot=[""], partitions=16)
    sizes = sorted(r["count"] for r in got.where("code = ''").groupBy(F.spark_partition_id()).count().collect())
    # AQE is on and the rows are few bytes: merged, all million pairs would be one task's.
    assert sum(sizes) == 1000 * 1000 and len(sizes) >= 8 and sizes[-1] < 300_000


def test_durations_spread_the_pairs_of_a_repeated_code(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = QUERIES["durations"](spark, SF_SMALL).where("booking_code = ''").select(F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) > 4 and len({r.p for r in rows}) > 1


@pytest.mark.parametrize("seconds", [0.0, 0.4, 59.999999, -0.4, -1.5, -60.000001, 86_400.0, 5e9])
def test_elapsed_seconds_truncate_both_ways(spark, seconds):
    row = spark.sql(f"SELECT timestamp'2018-03-25 00:59:59.7' a, timestamp_micros(unix_micros(timestamp'2018-03-25 00:59:59.7') + bigint({round(seconds * 1e6)})) b")
    out = row.select(elapsed_seconds("a", "b").alias("n"), F.timestamp_diff("SECOND", "a", "b").alias("m"), elapsed_seconds("a", F.lit(None).cast("timestamp")).alias("none")).first()
    assert out.n == out.m == int(seconds) and out.none is None


def test_cube_with_a_hot_code_is_the_plain_cube(spark):
    t = dict(standin_tables(spark, SF_SMALL))
    third = lambda c, key: F.when(F.col(key) % 3 == 0, F.lit("PARTNER-00000001-3")).otherwise(F.col(c))
    t["bookings"] = t["bookings"].withColumn("code", third("code", "id"))
    t["receipts"] = t["receipts"].withColumn("booking_code", F.when(F.col("tolls_and_surcharges") % 3 == 0, F.lit("PARTNER-00000001-3")).otherwise(F.col("booking_code")))
    once = {c: F.col(c) for c in ("tolls_and_surcharges", "booking_fee")}
    t["receipts"] = t["receipts"].dropDuplicates(["booking_code", *once])
    plain, salted = (runner.build(t, replace(PARAMS, hot_share=share), until="daily_metrics") for share in (2.0, 0.05))
    assert salted["booking_facts"].where("is_hot").count() > 0 and plain["booking_facts"].where("is_hot").count() == 0
    assert rows_of(salted["daily_metrics"]) == rows_of(plain["daily_metrics"])


# --- validity ranges --------------------------------------------------------------------

T0 = dt.datetime(2018, 1, 1)


def _versions(n, rng):
    out = [(0, None, None, "always"), (0, None, T0, "open start"), (0, T0, None, "no end"), (0, T0, T0, "empty"), (2, None, None, "no bookings")]
    for i in range(n):
        start = T0 + dt.timedelta(seconds=rng.randrange(90 * 86_400))
        out.append((rng.randrange(2), start, start + dt.timedelta(seconds=rng.randrange(1, 5 * 86_400)), f"v{i}"))
    return out


def test_interval_join_and_counts_equal_the_plain_test(spark):
    rng = random.Random(8)
    versions = _versions(60, rng)
    moments = [None, T0, *[v[1] for v in versions if v[1]], *[v[2] for v in versions if v[2]], *[T0 + dt.timedelta(seconds=rng.randrange(95 * 86_400)) for _ in range(60)]]
    bookings = [(i, i % 4, m) for i, m in enumerate(moments * 2)]
    holds = lambda m, v: v[1] is None or (m is not None and v[2] is not None and v[1] <= m < v[2])
    b = spark.createDataFrame(bookings, "id int, type int, at timestamp")
    v = spark.createDataFrame(versions, "key int, start timestamp, end timestamp, name string")
    got = interval_join(b, v, ("type", "key"), "at", "start", "end").select("id", "name")
    assert rows_of(got) == sorted(((i, v[3]) for i, k, m in bookings for v in versions if k == v[0] and holds(m, v)), key=str)
    for seconds in (86_400, 3_600):
        counted = with_valid_counts(b, v.drop("name"), "type", "at", seconds).select("id", "n_versions", "n_valid")
        want = [(i, sum(k == v[0] for v in versions), sum(k == v[0] and holds(m, v) for v in versions)) for i, k, m in bookings if k in {v[0] for v in versions}]
        assert rows_of(counted) == sorted(want, key=str)


def test_a_type_with_very_many_versions(spark):
    # 100,000 versions of ten minutes each, one after the other: every moment is in one of them.
    v = spark.range(100_000).select(
        F.lit(1).alias("key"), F.timestamp_seconds(F.col("id") * 600).alias("start"), F.timestamp_seconds((F.col("id") + 1) * 600).alias("end")
    )
    b = spark.range(200_000).select("id", F.lit(1).alias("type"), F.timestamp_seconds(F.col("id") * 301).alias("at"))
    got = with_valid_counts(b, v, "type", "at").agg(F.count(F.lit(1)), F.min("n_valid"), F.max("n_valid"), F.max("n_versions")).first()
    inside = 200_000  # up to 200,000 * 301 seconds; the versions end at 60,000,000
    held = b.where(F.unix_seconds("at") < 60_000_000).count()
    assert got[0] == inside and got[2] == 1 and got[3] == 100_000 and got[1] == (1 if held == inside else 0)
    joined = interval_join(b, v, ("type", "key"), "at", "start", "end")
    assert joined.count() == held
    assert "collect_list" not in plan_of(joined)


# --- late materialisation, JSON, pruning ---------------------------------------------------


def inputs_of(plan: str, operator: str) -> list[str]:
    return re.findall(rf"\) {operator}\nInput \[\d+\]: \[(.*?)\]\n", plan)


def test_winners_meet_the_wide_sides_after_the_top_1(spark, no_broadcast):
    plan = plan_of(QUERIES["last_attempt"](spark, SF_SMALL))
    ranked = inputs_of(plan, "Window")
    # The first ranking reads three columns of the invoices; quotes and names meet its winners only.
    narrow = [columns for columns in ranked if "merchant_name" not in columns]
    assert len(ranked) == 2 and len(narrow) == 1 and narrow[0].count("#") == 3
    # What is ranked by invoice crosses the network in these columns alone.
    assert not any("merchant_name" in columns and "fail_time" in columns and "hashpartitioning(invoice" in columns for columns in inputs_of(plan, "Exchange"))


def test_json_is_parsed_once_and_crosses_no_join(spark, no_broadcast):
    plan = plan_of(QUERIES["durations"](spark, SF_SMALL))
    assert plan.count("from_json") == 1 and "get_json_object" not in plan
    moved = inputs_of(plan, "Exchange")
    assert len(moved) == 2 and not any("timeline" in columns for columns in moved)


def test_json_fields_equal_the_single_lookups(spark):
    from parcelmart.functions.scalar import json_fields, json_text

    texts = ['{"a": "x", "b": "y"}', '{"a": "x", "b": ', '{"a": "x" "b": "y"}', "{}", "x", "", None, '{"a": 12, "b": null}', '{"a": {"c": 1}, "b": [1, 2]}',
             '{"a": true, "b": 1.50}', '["a"]', '{"A": "x"}']
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    both = df.select(json_fields("j", ["a", "b"]).alias("f"), json_text("j", "$.a").alias("a"), json_text("j", "$.b").alias("b"))
    assert both.where("NOT (f.a <=> a AND f.b <=> b)").collect() == []


def test_candidates_are_pruned_by_the_dates_of_bookings(spark):
    plan = plan_of(catalog._mart_outputs(spark, SF_SMALL, "cube_candidates")[1]["cube_candidates"])
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(partition_date" in plan


# --- publishing ----------------------------------------------------------------------------


def test_runner_publishes_steps_under_their_names(spark, tmp_path):
    t, base = standin_tables(spark, SF_SMALL), str(tmp_path / "mart")
    for _ in range(2):
        out = runner.run(spark, t, PARAMS, steps=["attempts_per_invoice"], publish_to=base)
    assert sorted(os.listdir(base)) == sorted(out)
    for name, frame in out.items():
        assert rows_of(published(spark, base, name).select(*frame.columns)) == rows_of(frame)


def test_two_publishers_at_once(spark, tmp_path):
    base, errors = str(tmp_path), []

    def work(n):
        try:
            publish(spark.range(n), base, "t", keep=4)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in (10, 20)]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    assert not errors
    assert published(spark, base, "t").count() in (10, 20)
    assert published(spark, base, "t").count() == published(spark, base, "t").count()


def test_reader_keeps_its_version_while_old_ones_go(spark, tmp_path):
    base = str(tmp_path)
    publish(spark.range(5), base, "t")
    publish(spark.range(6), base, "t")
    reader = published(spark, base, "t")
    publish(spark.range(7), base, "t")  # removes the first version, not the reader's
    assert reader.count() == 6 and published(spark, base, "t").count() == 7
    # An unfinished version is not read.
    os.makedirs(f"{base}/t/v000009-00000000")
    assert published(spark, base, "t").count() == 7


def test_mart_copy_leaves_its_folder_to_the_end_of_the_application(spark):
    before = set(os.listdir(checkpoint_dir(spark)))
    assert QUERIES["mart_copy"](spark, SF_SMALL).count() > 0
    made = [n for n in set(os.listdir(checkpoint_dir(spark))) - before if n.startswith("parcelmart-run-")]
    for name in made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/{name}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # Tells whether the folder was on the list of those that go; it is put back there.
        assert fs.cancelDeleteOnExit(path) and fs.deleteOnExit(path)
