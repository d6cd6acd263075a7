"""The registered queries: every operator run over the provided tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the mart's
queries write the stand-in sources and upstream steps that they read, as stored
tables, while they are built. Column names match the oracle SQL in ``parcelmart.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions import arrays as _arr, text as _txt
from parcelmart.functions import scalar as _x
from parcelmart.functions.tokens import reset_url as _reset_url
from parcelmart.operators import bucketize
from parcelmart.operators.hot_keys import SALTS, hot_key_join as _hot_key_join, hot_values as _hot_values, is_hot as _is_hot, salted_key as _salted_key
from parcelmart.operators.intervals import interval_join as _interval_join
from parcelmart.operators.relational import anti as _anti, mark_hits as _mark_hits
from parcelmart.plans import mart as _mart
from parcelmart.plans.metrics import CANCELLED_STATES, RIDE_STATES
from parcelmart.plans.runner import DEPENDS_ON, STEPS, run as _run, store_step, upstream_of
from parcelmart.session import delete_at_end
from parcelmart.sources.sinks import new_run_dir, published, write_table
from parcelmart.sources.standins import STANDIN_FAMILY, StandinTables, standin_tables
from parcelmart.sources.tables import load

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def bucket_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 over line prices, width 5.00."""
    return bucketize(load(spark, sf_dir, "lineitem"), "l_extendedprice", width=5)


@query
def bucket_histogram_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 over account balances, which go negative: floor rounds toward -inf."""
    return bucketize(load(spark, sf_dir, "customer"), "c_acctbal", width=5)


# --- the booking mart over stand-in sources -------------------------------------------


PARAMS = _mart.MartParams(type_family=STANDIN_FAMILY)

# Upstream steps that a query reads are stored, as the source pipeline stores
# every step and later steps read the stored table: once for a state of the
# sources, in a folder that goes with the application.
_STORED: dict[int, tuple[str, StandinTables, dict]] = {}


def _stored_steps(spark: SparkSession, t: StandinTables, names: list[str]) -> dict:
    run_dir, _, stored = _STORED.setdefault(id(t), (new_run_dir(spark), t, {}))
    for name, step in STEPS:
        if name in names and name not in stored:
            stored[name] = store_step(step(t, PARAMS, stored), name, run_dir, t.buckets)
            delete_at_end(spark, run_dir)
    return dict(stored)


def _mart_inputs(spark: SparkSession, sf_dir: str, reads: list[str]):
    """Sources plus the stored derived tables ``reads`` (and what they read)."""
    t = standin_tables(spark, sf_dir)
    return t, _stored_steps(spark, t, [*upstream_of(reads), *reads])


def _mart_outputs(spark: SparkSession, sf_dir: str, until: str):
    """Sources plus step ``until`` as a lazy plan over its stored inputs."""
    t, d = _mart_inputs(spark, sf_dir, DEPENDS_ON[until])
    d[until] = dict(STEPS)[until](t, PARAMS, d)
    return t, d


@query
def metrics_cube(spark, sf_dir):
    """The 64-metric daily cube."""
    return _mart_outputs(spark, sf_dir, "daily_metrics")[1]["daily_metrics"]


@query
def invoice_pivot(spark, sf_dir):
    """Invoice-level summary of last/first attempts and durations."""
    return _mart_outputs(spark, sf_dir, "invoice_summary")[1]["invoice_summary"]


@query
def fare_resolution(spark, sf_dir):
    """B2: passenger fare per partner booking."""
    return _mart_outputs(spark, sf_dir, "pax_fares")[1]["pax_fares"]


@query
def union_distinct_map(spark, sf_dir):
    """Booking -> invoice mapping."""
    return _mart_outputs(spark, sf_dir, "booking_invoice")[1]["booking_invoice"]


@query
def max_code_union(spark, sf_dir):
    """Largest service-type code per booking."""
    return _mart_outputs(spark, sf_dir, "service_type_map")[1]["service_type_map"]


@query
def split_merchant_id(spark, sf_dir):
    """Partner id per booking."""
    return _mart_outputs(spark, sf_dir, "merchant_mapping")[1]["merchant_mapping"]


@query
def distinct_counts(spark, sf_dir):
    """Attempts per invoice."""
    return _mart_outputs(spark, sf_dir, "attempts_per_invoice")[1]["attempts_per_invoice"]


@query
def last_attempt(spark, sf_dir):
    """Latest attempt per invoice."""
    t, d = _mart_inputs(spark, sf_dir, ["cube_merchants", "service_type_map", "partner_invoices", "deliveries"])
    return _mart.last_attempts(t, PARAMS, d)


@query
def first_attempt(spark, sf_dir):
    """Earliest attempt per invoice."""
    t, d = _mart_inputs(spark, sf_dir, ["partner_invoices"])
    return _mart.first_attempts(t, PARAMS, d)


# --- single operators over the stand-in sources --------------------------------------


_METRICS_FROM = PARAMS.metrics_from

#: A code above this share of the bookings is joined apart where its rows meet in pairs: 0.0005 of 10 million are 5,000 rows.
PAIR_SHARE = 0.0005


def _src(spark, sf_dir):
    return standin_tables(spark, sf_dir)


@query
def partner_filter(spark, sf_dir):
    """Partner, unique, allowed country, ride or cancelled state."""
    bk = _src(spark, sf_dir)["bookings"]
    return bk.where(
        _x.has_prefix("code", "PARTNER")
        & _x.not_blank("code")
        & (F.col("is_unique_booking") == "t")
        & ~F.col("country_id").isin(*PARAMS.excluded_countries)
        & (F.col("state").isin(*RIDE_STATES) | F.col("state").isin(*CANCELLED_STATES))
    ).select("id", F.col("code").alias("booking_code"), "state", "country_id")


@query
def string_date_filter(spark, sf_dir):
    """Text partition keys vs. parsed dates."""
    rec = _src(spark, sf_dir)["receipts"]
    since = _x.day_before(_METRICS_FROM)
    return rec.where(_x.parts_text("year", "month", "day") >= since).select(
        "booking_code",
        _x.parts_text("year", "month", "day").alias("part_key"),
        _x.date_from_parts("year", "month", "day").alias("part_date"),
        (_x.date_from_parts("year", "month", "day") >= F.lit(since).cast("date")).alias("date_passes"),
        F.date_format(_x.date_from_parts("year", "month", "day"), "yyyy-MM-dd").alias("part_text"),
    )


@query
def timestamp_filter(spark, sf_dir):
    """Parsed text timestamp compared with a parsed constant."""
    ub = _src(spark, sf_dir)["unique_bookings"]
    first = _x.parse_ts("first_at")
    return ub.where(first >= F.to_timestamp(F.lit(_METRICS_FROM), "yyyy-MM-dd")).select(
        "last_id", first.alias("first_at_ts"), "first_allocated"
    )


@query
def json_value(spark, sf_dir):
    """Scalar JSON values as text, double and int."""
    ev = load(spark, sf_dir, "events")
    k = _x.json_double("props", "$.k")
    return ev.where(k.isNotNull()).select(
        "event_id",
        _x.json_text("props", "$.k").alias("k_text"),
        k.alias("k_double"),
        _x.json_int("props", "$.k").alias("k_int"),
        _x.json_text("props", "$.missing").alias("missing"),
    )


@query
def json_nested(spark, sf_dir):
    """Integer at a three-level JSON path; fractions and absent keys give NULL."""
    bs = _src(spark, sf_dir)["booking_service"]
    return bs.select("booking_code", _x.json_int("metadata", "$.expressMeta.jobCard.jobType").alias("job_type"))


@query
def month_rate_join(spark, sf_dir):
    """Rate of the booking's country and month; fare in USD."""
    t = _src(spark, sf_dir)
    bk = t["bookings"].select("id", "country_id", "date_local", "fare")
    out = _mart.with_month_rate(bk, t["exchange_rates"], "country_id", F.to_date(F.col("date_local")))
    return out.select("id", "country_id", "date_local", "exchange_one_usd",
                      _x.per_rate(F.col("fare"), F.col("exchange_one_usd")).alias("fare_usd"))


@query
def validity_join(spark, sf_dir):
    """Type dimension joined twice, the second copy range-tested."""
    t = _src(spark, sf_dir)
    types = _mart.express_taxi_types(t, PARAMS)
    bk = t["bookings"].select("id", "taxi_type_id", "created_at_local")
    ge = types.select(F.col("taxi_type_id").alias("_ge_id"))
    tt = types.select(F.col("taxi_type_id").alias("_tt_id"), "name", "start_at", "end_at")
    valid = _interval_join(bk, tt, ("taxi_type_id", "_tt_id"), "created_at_local", "start_at", "end_at")
    return valid.join(ge, valid["taxi_type_id"] == ge["_ge_id"]).select("id", "taxi_type_id", "name", "start_at", "end_at")


@query
def anti_join(spark, sf_dir):
    """Bookings that are not test bookings."""
    t = _src(spark, sf_dir)
    return _anti(t["bookings"].select("id", "code"), t["test_bookings"].select(F.col("code").alias("_tb")),
                 F.col("code") == F.col("_tb"))


@query
def vacuous_anti_join(spark, sf_dir):
    """The source's test filter that can never match (its ON requires a NULL key).

    Written literally; Catalyst sees the join cannot produce matches and removes it.
    """
    t = _src(spark, sf_dir)
    bk = t["bookings"].select("id", "code")
    tb = t["test_bookings"].select(F.col("code").alias("_tb"))
    return bk.join(tb, (F.col("_tb") == F.col("code")) & F.col("_tb").isNull(), "left").where(
        F.col("_tb").isNull()
    ).select("id", "code")


@query
def left_join_filtered(spark, sf_dir):
    """Left join to a filtered subquery with a hit marker."""
    t = _src(spark, sf_dir)
    promo = _mark_hits(
        t["promo_bookings"].where(F.col("date_local") >= F.to_timestamp(F.lit(_METRICS_FROM), "yyyy-MM-dd"))
        .select(F.col("code").alias("_p_code"), "promo_expense_local"),
        "promo",
    )
    bk = t["bookings"].select("id", "code")
    return bk.join(promo, bk["code"] == promo["_p_code"], "left").select("id", "code", "promo", "promo_expense_local")


@query
def left_join_preagg(spark, sf_dir):
    """Left join to a per-booking SUM computed before the join."""
    t = _src(spark, sf_dir)
    inc = (
        t["incentive_payouts"].where(F.col("date_partition") >= _x.day_before(_METRICS_FROM))
        .groupBy(F.col("booking_code").alias("_i_code")).agg(F.sum("payout_per_ride").alias("incentive_payout"))
    )
    bk = t["bookings"].select("id", "code")
    return bk.join(inc, bk["code"] == inc["_i_code"], "left").select("id", "code", "incentive_payout")


@query
def composite_join_centroid(spark, sf_dir):
    """Area by (geohash, city, country) with polygon centroid."""
    t = _src(spark, sf_dir)
    area = _mart.area_lookup(t).select(
        F.col("geohash").alias("_g"), F.col("city_id").alias("_ci"), F.col("country_id").alias("_co"),
        "area", "latitude", "longitude",
    )
    bk = t["bookings"].select("id", "pickup_geohash", "city_id", "country_id")
    return bk.join(
        area, (area["_g"] == bk["pickup_geohash"]) & (area["_ci"] == bk["city_id"]) & (area["_co"] == bk["country_id"]),
        "left",
    ).select(
        "id",
        _x.strip_digits(F.coalesce(F.col("area"), F.lit("Other Areas"))).alias("pickup_area"),
        "latitude",
        "longitude",
    )


@query
def inner_residual_join(spark, sf_dir):
    """Inner equi-join with single-side residual predicates in the ON clause."""
    t = _src(spark, sf_dir)
    types = _mart.express_taxi_types(t, PARAMS)
    job = _x.json_int("metadata", "$.expressMeta.jobCard.jobType")
    bs = t["booking_service"]
    return bs.join(
        types.select("taxi_type_id"),
        (bs["vehicle_type_id"] == types["taxi_type_id"])
        & (_x.date_from_parts(bs["year"], bs["month"], bs["day"]) > F.lit(PARAMS.service_after).cast("date"))
        & job.isNotNull(),
    ).select("booking_code", "vehicle_type_id", job.alias("service_type"))


@query
def fanout_join(spark, sf_dir):
    """Left join whose columns are unused still repeats rows (kept for parity)."""
    t, d = _mart_inputs(spark, sf_dir, ["booking_invoice"])
    bi = d["booking_invoice"].select(F.col("booking_code").alias("_b"), "invoice_number")
    bk = t["bookings"].select("id", "code")
    # A code that holds a large share of the bookings would be one task's: such codes are joined apart.
    return _hot_key_join(bk, bi, ("code", "_b"), "id").groupBy("id").agg(F.count(F.lit(1)).alias("rows_after_join"))


@query
def durations(spark, sf_dir):
    """ISO timeline text -> timestamps -> whole seconds and minutes."""
    t = _src(spark, sf_dir)
    # One parse of each text, at its scan; three timestamps cross the join.
    parsed = t["delivery_booking"].select("booking_code", _x.json_fields("timeline", ["allocate", "pickup", "fail"]).alias("at"))
    db = parsed.select("booking_code", *[_x.parse_iso_z(F.col("at")[k]).alias(k) for k in ("allocate", "pickup", "fail")])
    db = db.withColumn("time_to_pick", _x.whole_minutes("allocate", "pickup"))
    bk = t["bookings"].select("id", "code", _x.parse_ts_dropping_millis("created_at", strict=True).alias("created"))
    created, alloc, fail = (F.col(c) for c in ("created", "allocate", "fail"))
    # The rows of a repeated code meet in pairs, as many as the square of its rows: such codes are spread over many tasks.
    hot = _hot_values(bk, "code", PAIR_SHARE)
    # One join for all codes, so that each text is parsed once; a delivery of such a code is there once for each salt.
    key = F.when(_is_hot(F.col("code"), hot), _salted_key(F.col("code"), F.col("id"))).otherwise(F.col("code"))
    salted = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda n: F.concat_ws("\0", "booking_code", n.cast("string")))
    keys = F.explode(F.when(_is_hot(F.col("booking_code"), hot), salted).otherwise(F.array("booking_code")))
    return db.withColumn("_key", keys).join(bk.withColumn("_code", key), F.col("_key") == F.col("_code")).select(
        "booking_code",
        alloc.alias("allocation_time"),
        _x.elapsed_seconds(created, alloc).alias("secs_to_allocate"),
        _x.whole_minutes(created, alloc).alias("time_to_allocate"),
        "time_to_pick",
        _x.whole_minutes(created, fail).alias("time_to_fail"),
    )


@query
def mart_copy(spark, sf_dir):
    """Run the dimension steps, write them, read the published copy back."""
    t = _src(spark, sf_dir)
    folder = new_run_dir(spark)
    delete_at_end(spark, folder)
    out = _run(spark, t, PARAMS, run_dir=folder, steps=["express_taxi_types", "merchants_snapshot"], buckets=t.buckets)
    return out["merchants_snapshot"].select("*")


@query
def published_attempts(spark, sf_dir):
    """The attempts per invoice, published with the steps before them, and read by their name."""
    t = _src(spark, sf_dir)
    folder = new_run_dir(spark)
    delete_at_end(spark, folder)
    _run(spark, t, PARAMS, steps=["attempts_per_invoice"], buckets=t.buckets, publish_to=folder)
    return published(spark, folder, "attempts_per_invoice")


# --- snippet operators over the provided tables ---------------------------------------


# The keywords searched for in ``word_search`` and the word looked up in ``list_index``.
SEARCH_KEYWORDS = ["the", "Le", "und", "casino", "qui", "Ère"]
LOOKUP_WORD = "the"


@query
def format_digits(spark, sf_dir):
    """Price printed with a per-row number of digits (Python rounding)."""
    part = load(spark, sf_dir, "part")
    digits = (F.col("p_size") % 4).cast("int")
    return part.select(
        "p_partkey", "p_retailprice", digits.alias("digits"),
        _txt.format_fixed("p_retailprice", digits).alias("price_text"),
        _txt.format_fixed(F.col("p_retailprice") / 8, 2).alias("eighth_text"),
    )


@query
def mod_default(spark, sf_dir):
    """Y2: Python modulo with default divisor 3, and with a negative divisor."""
    o = load(spark, sf_dir, "orders")
    total = F.col("o_custkey") - 500
    return o.select("o_orderkey", total.alias("total"), _txt.py_mod(total).alias("left_over"),
                    _txt.py_mod(total, -7).alias("left_over_neg"))


@query
def list_index(spark, sf_dir):
    """0-based position of a word in each document's space-split text (NULL if absent)."""
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", _arr.index_of(F.split("text", " "), LOOKUP_WORD).alias("position"))


@query
def any_multiple(spark, sf_dir):
    """Y8 (grouped form): does any line quantity of an order divide by 7."""
    li = load(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(_arr.any_multiple_agg("l_quantity", 7).alias("has_multiple"))


@query
def nested_index(spark, sf_dir):
    """``x[2, -1]`` on each embedding viewed as rows of 8."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", _arr.at(_arr.rows_of("embedding", 8), 2, -1).alias("value"))


@query
def to_array(spark, sf_dir):
    """Float list -> array<double>."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", _arr.to_double_array("embedding").alias("vec"))


@query
def array_add(spark, sf_dir):
    """Add 10 to every element."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", _arr.add_scalar(_arr.to_double_array("embedding"), 10).alias("vec"))


@query
def grade_message(spark, sf_dir):
    """pass/fail outcome and the printed message for grade = 2 x size."""
    part = load(spark, sf_dir, "part")
    grade = F.col("p_size") * 2
    return part.select("p_partkey", grade.alias("grade"), _txt.pass_or_fail(grade).alias("outcome"),
                       _txt.grade_sentence(grade).alias("message"))


@query
def map_lines(spark, sf_dir):
    """``k = v`` lines for a name -> segment dictionary."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", _txt.key_value_line("c_name", "c_mktsegment").alias("line"))


@query
def rjust_labels(spark, sf_dir):
    """Right-justified names with their initial."""
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", _txt.begins_with_line("p_name", F.upper(F.substring("p_name", 1, 1))).alias("line"))


@query
def word_search(spark, sf_dir):
    """Documents containing each keyword as a whole normalised token."""
    d = load(spark, sf_dir, "documents")
    return _txt.word_search(d, "text", SEARCH_KEYWORDS, "doc_id")


@query
def keyword_table(spark, sf_dir):
    """Y7 with a table of keywords: the documents that hold each word of the benchmark items."""
    d = load(spark, sf_dir, "documents")
    words = load(spark, sf_dir, "benchmark").select(F.explode(_txt.word_tokens("text")).alias("word"))
    return _txt.keyword_hits(d, "text", words, "word", "doc_id")


@query
def argmin_as_int(spark, sf_dir):
    """Smallest of three numeric strings by integer value, first wins ties."""
    p = load(spark, sf_dir, "part")
    s1 = F.col("p_size").cast("string")
    s2 = F.lpad((F.col("p_size") % 10).cast("string"), 2, "0")
    s3 = (F.col("p_partkey") % 50).cast("string")
    return p.select("p_partkey", s1.alias("s1"), s2.alias("s2"), s3.alias("s3"),
                    _arr.min_as_int(s1, s2, s3).alias("smallest"))


@query
def token_url(spark, sf_dir):
    """A reset URL with a fresh URL-safe token per customer (no oracle)."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", _reset_url("https://example.invalid/reset=", "c_custkey").alias("url"))


@query
def token_shape(spark, sf_dir):
    """What is fixed about a random reset URL: its start, the token's length and letters, no token twice."""
    c = load(spark, sf_dir, "customer")
    start = "https://example.invalid/reset="
    # The tokens are random: written once, so that the shape and the counts speak of the same ones.
    made = c.select("c_custkey", _reset_url(start, "c_custkey").alias("url"))
    folder = new_run_dir(spark)
    delete_at_end(spark, folder)
    made = write_table(made, f"{folder}/tokens").withColumn("token", F.expr(f"substr(url, {len(start) + 1})"))
    seen = made.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return made.join(seen, "token").select(
        "c_custkey", F.col("url").startswith(start).alias("starts_right"), F.length("token").alias("token_length"),
        F.col("token").rlike("^[A-Za-z0-9_-]+$").alias("safe_letters"), (F.col("n") == 1).alias("all_distinct"),
    )


@query
def bucket_histogram_quarter(spark, sf_dir):
    """B1 with a fractional width: quarters of account balances."""
    return bucketize(load(spark, sf_dir, "customer"), "c_acctbal", width=0.25)


@query
def bucket_histogram_tenth(spark, sf_dir):
    """B1 with width 0.1, which no double holds exactly."""
    return bucketize(load(spark, sf_dir, "lineitem"), "l_discount", width=0.1)


@query
def merchant_code_join(spark, sf_dir):
    """Left join of merchants on the number inside the booking code, ``substr(code, 9, 8)``."""
    t = _src(spark, sf_dir)
    bk = t["bookings"].where(_x.has_prefix("code", _mart.PARTNER)).select("id", "code", F.substring("code", 9, 8).alias("_number"))
    m = t["merchants"].select(F.lpad(F.col("merchant_id").cast("string"), 8, "0").alias("_m"), "merchant_name")
    return bk.join(m, bk["_number"] == m["_m"], "left").select("id", "code", "merchant_name")


@query
def map_entry_lines(spark, sf_dir):
    """Y5 over a real map: a ``k = v`` line for each entry of every event's properties."""
    e = load(spark, sf_dir, "events")
    entries = e.select("event_id", F.explode_outer(F.from_json("props", "map<string,string>")).alias("k", "v")).where("k IS NOT NULL")
    return entries.select("event_id", _txt.key_value_line("k", "v").alias("line"))


@query
def any_multiple_list(spark, sf_dir):
    """Y8 over a list: do a vector's components, in whole hundredths, hold a multiple of seven."""
    e = load(spark, sf_dir, "embeddings")
    numbers = F.transform("embedding", lambda x: F.floor(x * 100))
    return e.select("vec_id", _arr.any_multiple(numbers, 7).alias("has_multiple"))


@query
def area_columns(spark, sf_dir):
    """Every column of the area map, with the centroid."""
    return _mart.area_lookup(_src(spark, sf_dir))


@query
def timestamp_minus_interval(spark, sf_dir):
    """A timestamp column less an interval column."""
    e = load(spark, sf_dir, "events")
    return e.select("event_id", _x.minus_interval("ts", (F.col("event_id") % 90).cast("int"), "mins").alias("earlier"))
