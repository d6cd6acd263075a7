"""DataFrame operators on edge fixtures, and invariants of the mart outputs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelmart.operators import bucketize, max_per_key, top1_per_group, union_distinct
from parcelmart.plans import mart, runner
from parcelmart.plans.catalog import PARAMS
from parcelmart.plans.metrics import METRICS
from parcelmart.sources.standins import standin_tables
from tests.conftest import SF_SMALL

ROWS = [
    ("a", "2018-01-02", "x1", 1),
    ("a", "2018-01-03", "x2", 2),
    ("a", "2018-01-03", "x0", 3),  # tie on the time: code decides
    ("a", None, "x9", 4),  # NULL time: never first nor last while others exist
    ("b", None, "y1", 5),
    (None, "2018-01-01", "z1", 6),  # NULL group is one group
    (None, "2018-01-05", "z2", 7),
]


@pytest.mark.parametrize("descending", [True, False])
def test_top1_per_group_equals_row_number(spark, descending):
    df = spark.createDataFrame(ROWS, "k string, t string, code string, v int")
    got = top1_per_group(df, "k", [F.col("t"), F.col("code")], descending=descending, columns=["t", "code", "v"])
    order = [F.desc_nulls_last("t"), F.desc_nulls_last("code")] if descending else \
        [F.asc_nulls_last("t"), F.asc_nulls_last("code")]
    w = Window.partitionBy("k").orderBy(*order)
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select("k", "t", "code", "v").collect()), key=str)


def test_bucketize_edges(spark):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (-0.01,), (None,), (12.5,)], "revenue double")
    got = [tuple(r) for r in bucketize(df, "revenue", 5).collect()]
    assert got == [(-5, "-5 to 0", 1), (0, "0 to 5", 2), (5, "5 to 10", 1), (10, "10 to 15", 1), (None, None, 1)]


def test_union_distinct_and_max(spark):
    a = spark.createDataFrame([("d1", "b1"), ("d1", "b1")], "delivery_code string, booking_code string")
    b = spark.createDataFrame([("d1", "b1"), ("d2", "b2")], "delivery_code string, booking_code string")
    assert union_distinct([a, b]).count() == 2
    s1 = spark.createDataFrame([("b1", 0), ("b2", None)], "booking_code string, service_type int")
    s2 = spark.createDataFrame([("b1", 1), ("b2", -1)], "booking_code string, service_type int")
    got = dict(map(tuple, max_per_key([s1, s2], "booking_code", "service_type").collect()))
    assert got == {"b1": 1, "b2": -1}


@pytest.fixture(scope="module")
def mart_outputs(spark):
    t = standin_tables(spark, SF_SMALL)
    return t, runner.build(t, PARAMS)


def test_cube_invariants(mart_outputs):
    _, d = mart_outputs
    cube = d["daily_metrics"].toPandas()
    assert len(cube) > 0
    assert (cube.unique_bookings <= cube.all_bookings).all()
    assert (cube.allocated_UB <= cube.allocated_nonUB).all()
    assert (cube.ub_cancelled <= cube.non_ub_cancelled).all()
    assert (cube.first_allocated_UB <= cube.first_allocated_bookings).all()
    # identical definitions under two names
    for a, b in [("non_ub_pax_cancelled", "job_cancelled_by_pax"), ("non_ub_opr_cancelled", "job_cancelled_by_ops"),
                 ("non_ub_driver_cancelled", "job_cancelled_by_dax"), ("ub_pax_cancelled", "booking_cancelled_by_pax"),
                 ("dax_fare_all_bookings", "fare_unique_bookings"),
                 ("dax_fare_all_bookings_USD", "fare_unique_bookings_USD")]:
        assert (cube[a] == cube[b]).all(), (a, b)
    assert list(cube.columns[10:]) == [m[0] for m in METRICS]


def test_cube_excludes_test_bookings(spark, mart_outputs):
    t, d = mart_outputs
    # Every booking of the cube input survives the anti join: test codes never reach it.
    tb = {r.code for r in t["test_bookings"].collect()}
    partner = mart.attempts_per_invoice(t, PARAMS, d)
    assert partner.count() > 0
    rows = mart.last_attempts(t, PARAMS, d).select("booking_code").collect()
    assert not ({r.booking_code for r in rows} & tb)


def test_attempts_vacuous_filter_option(mart_outputs):
    t, d = mart_outputs
    from dataclasses import replace

    keep = mart.attempts_per_invoice(t, PARAMS, d).agg(F.sum("non_UB")).first()[0]
    drop = mart.attempts_per_invoice(t, replace(PARAMS, exclude_test_in_attempts=True), d).agg(F.sum("non_UB")).first()[0]
    assert drop < keep


def test_runner_writes_and_rereads(spark, mart_outputs, tmp_path):
    t, d = mart_outputs
    out = runner.run(spark, t, PARAMS, run_dir=str(tmp_path / "run"),
                     steps=["express_taxi_types", "pax_fares", "booking_invoice"])
    for name in ["express_taxi_types", "pax_fares", "booking_invoice"]:
        assert (tmp_path / "run" / name).exists()
        assert sorted(map(tuple, out[name].collect()), key=str) == sorted(map(tuple, d[name].collect()), key=str)


def test_spread_null_key_matches_like_plain_left_join(spark):
    from parcelmart.operators.relational import spread_null_key

    left = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "b")], "id int, code string")
    right = spark.createDataFrame([("a", 10), (None, 20), ("b", 30), ("b", 31)], "rcode string, v int")
    plain = left.join(right, left["code"] == right["rcode"], "left").select("id", "v")
    spread = (
        left.withColumn("_jk", spread_null_key(F.col("code"), F.col("id")))
        .join(right, F.col("_jk") == right["rcode"], "left")
        .select("id", "v")
    )
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    anti_plain = left.join(right, left["code"] == right["rcode"], "left_anti").count()
    anti_spread = left.withColumn("_jk", spread_null_key(F.col("code"), F.col("id"))).join(
        right, F.col("_jk") == right["rcode"], "left_anti").count()
    assert anti_plain == anti_spread == 2


def test_weighted_distinct_preserves_left_join_sums(spark):
    from parcelmart.operators.relational import spread_null_key, weighted_distinct

    left = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0), (3, None, 5.0)], "id int, code string, x double")
    right = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 7)], "rcode string, v int")
    plain = left.join(right, left["code"] == right["rcode"], "left").groupBy("v").agg(
        F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))
    side = weighted_distinct(right, "rcode", "_w")
    weighted = (
        left.withColumn("_jk", spread_null_key(F.col("code"), F.col("id")))
        .join(side, F.col("_jk") == side["rcode"], "left")
        .withColumn("_w", F.coalesce("_w", F.lit(1)))
        .groupBy("v").agg(F.sum(F.col("x") * F.col("_w")).alias("s"), F.sum("_w").alias("n"))
    )
    assert sorted(map(tuple, weighted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert side.count() == 3


def test_appended_files_are_seen(spark, tmp_path):
    from parcelmart.plans.catalog import QUERIES
    from parcelmart.sources.sinks import publish, published
    from parcelmart.sources.tables import TABLE_NAMES, load

    for name in TABLE_NAMES:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    sf_dir = str(tmp_path)
    before = load(spark, sf_dir, "lineitem").count(), QUERIES["anti_join"](spark, sf_dir).count()
    orders = load(spark, sf_dir, "orders")
    orders.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_007).write.mode("append").parquet(f"{sf_dir}/orders.parquet")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").write.mode("append").parquet(f"{sf_dir}/lineitem.parquet")
    assert load(spark, sf_dir, "lineitem").count() == 2 * before[0]
    assert QUERIES["anti_join"](spark, sf_dir).count() > before[1]

    base = str(tmp_path / "published")
    for n in (3, 4, 5):
        publish(spark.range(n), base, "t", keep=2)
    assert published(spark, base, "t").count() == 5
    assert sorted(p.name[:7] for p in (tmp_path / "published" / "t").iterdir() if p.name[0] == "v") == ["v000002", "v000003"]
    with pytest.raises(LookupError):
        published(spark, base, "other")


def test_runner_builds_only_what_is_asked_for(spark, mart_outputs, tmp_path):
    t, _ = mart_outputs
    out = runner.run(spark, t, PARAMS, run_dir=str(tmp_path / "few"), steps=["merchants_snapshot", "service_type_map"])
    assert set(out) == {"merchants_snapshot", "service_type_map", "express_taxi_types"}


def test_mart_options(mart_outputs):
    from dataclasses import replace

    t, d = mart_outputs
    every, mapped = (mart.partner_invoices(t, replace(PARAMS, drop_unmapped=x), d) for x in (False, True))
    assert mapped.where("invoice_number IS NULL").count() == 0
    assert mapped.count() == every.where("invoice_number IS NOT NULL").count()
    once = mart.daily_metrics(t, replace(PARAMS, single_type_join=True), d).agg(F.sum("all_bookings")).first()[0]
    assert 0 < once < d["daily_metrics"].agg(F.sum("all_bookings")).first()[0]


def test_unreadable_first_attempt_times(spark, mart_outputs):
    from dataclasses import replace

    t, d = mart_outputs
    rows = {**d, "partner_invoices": d["partner_invoices"].withColumn("created_at", F.lit("no time"))}
    got = mart.first_attempts(t, replace(PARAMS, on_error="null"), rows)
    assert got.count() > 0 and got.where("first_time_stamp IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="no time|CANNOT_PARSE"):
        mart.first_attempts(t, PARAMS, rows).collect()


def test_uniqueness_report(mart_outputs):
    t, d = mart_outputs
    report = {r.table: (r.repeated_keys, r.extra_rows) for r in mart.uniqueness_report(t, d).collect()}
    assert set(report) == set(mart.CUBE_JOIN_KEYS) and report["merchants"] == (0, 0)
    assert report["merchant_mapping"][0] > 0 and report["merchant_mapping"][1] >= report["merchant_mapping"][0]
