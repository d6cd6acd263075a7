"""The booking mart: one function per derived table (S4/S8 steps of the source).

Inputs are a ``dict[str, DataFrame]`` of source tables (names as in
``parcelmart.sources.standins.MART_SOURCES``) plus the derived tables of the
earlier steps; ``MartParams`` carries the constants the source hard-codes.

Plan shape, per step: filters and projections are written against the scans
so they reach the parquet reader; small dimensions (vehicle types, rates,
areas, merchants) are plain joins that Spark broadcasts when their measured
size is under the broadcast threshold and sort-merge joins otherwise; the
large joins on the booking code are grouped so the booking side is shuffled
once and the following joins on the same key reuse that partitioning.

Rewrites against the source text (same results, cheaper plans):

* ``LEFT JOIN t ... WHERE t.key IS NULL`` is a left anti join;
* ``LEFT JOIN`` followed by a NULL-rejecting ``WHERE`` on the right side is an
  inner join, or a left semi join when the right columns are unused and the
  result is de-duplicated anyway;
* joins whose columns are unused under a ``COUNT(DISTINCT)`` or a
  de-duplication are dropped (they can only repeat rows);
* ``DISTINCT`` inside ``UNION ALL`` branches is dropped when a later
  ``DISTINCT`` or ``MAX`` absorbs it;
* ROW_NUMBER()=1 per invoice breaks its ties on every column, so the source's
  DISTINCT before it is not needed (see ``operators.relational.top1_per_group``);
* joins on other keys than the booking code run while each booking is still
  one row, in a step of their own (``booking_facts``); tables keyed by another
  code (merchants, vehicle types, delivery info) are joined to their mapping
  first, in steps too. All of these are stored clustered by the booking code
  (``runner.CLUSTERED``), so the joins on it shuffle nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.scalar import (
    date_from_parts,
    day_before,
    elapsed_seconds,
    has_prefix,
    json_double,
    json_fields,
    json_int,
    json_text,
    month_start,
    not_blank,
    parse_iso_z,
    parse_ts,
    parse_ts_dropping_millis,
    parts_text,
    per_rate,
    split_part,
    strip_digits,
    week_start,
    whole_minutes,
)
from parcelmart.operators.hot_keys import HOT_SHARE, hot_values, is_hot, salted_copies, salted_key
from parcelmart.operators.intervals import with_valid_counts
from parcelmart.operators.relational import (
    anti,
    conditional_sum,
    max_per_key,
    spread_null_key,
    top1_per_group,
    union_distinct,
    weighted_distinct,
)
from parcelmart.plans.metrics import (
    CANCELLED_STATES,
    COUNT_MEASURES,
    METRICS,
    RIDE_STATES,
    UNALLOCATED_STATE,
)
from parcelmart.session import delete_at_end
from parcelmart.sources.sinks import new_run_dir, write_table

PARTNER = "PARTNER"

# Service-type codes and their labels.
SERVICE_CODES = {"INSTANT": 0, "SAME_DAY": 1}
SERVICE_LABELS = {0: "Instant", 1: "SameDay", 2: "Multimodal"}


@dataclass(frozen=True)
class MartParams:
    """Constants of the source mart, as parameters (defaults = source values)."""

    type_family: str  # taxi_type_simple of the delivery product (required)
    year: str = "2018"
    fares_from: str = "2018-01-01"  # step 1: partition date >=
    service_after: str = "2018-01-01"  # step 4: partition date >
    mapping_after: str = "2018-02-01"  # step 14: partition_date >
    metrics_from: str = "2018-02-01"  # step 6: date_local >=; partitions from the day before
    attempts_from: str = "2018-01-01"  # steps 8 and 10: partition_date >=
    excluded_countries: tuple = (7, 8)
    exclude_test_in_attempts: bool = False  # step 8's test filter is vacuous in the source
    end_date: str | None = None  # step 1: last partition date (the source has no upper bound)
    on_error: str = "fail"  # unreadable first_at and first-attempt times: "fail", or "null"
    drop_unmapped: bool = False  # leave out bookings without an invoice (the source keeps them as one NULL group)
    single_type_join: bool = False  # count a booking once per valid type version, not once more per version
    hot_share: float = HOT_SHARE  # booking codes above this share of the bookings are joined apart, salted


# --- step 12 and 13: dimension copies -----------------------------------------------

def express_taxi_types(t: dict, p: MartParams) -> DataFrame:
    """B6 (step 12): vehicle types of the delivery family, id renamed."""
    return t["taxi_types"].where(F.col("taxi_type_simple") == p.type_family).select(
        F.col("id").alias("taxi_type_id"),
        "country_id",
        "city_id",
        "name",
        "start_at",
        "end_at",
        "taxi_type_simple",
    )


def merchants_snapshot(t: dict, p: MartParams) -> DataFrame:
    """S7 (step 13): unmodified copy of the merchants table."""
    return t["merchants"].select("*")


# --- step 1: passenger fares ---------------------------------------------------------

def pax_fares(t: dict, p: MartParams) -> DataFrame:
    """B2 (step 1): quoted amount, else booking fare, else 0, per partner booking."""
    info = t["delivery_info"].where(
        (date_from_parts("year", "month", "day") >= F.lit(dt.date.fromisoformat(p.fares_from)))
        & not_blank("delivery_code")
        & (F.col("year") == p.year)
    )
    if p.end_date is not None:
        info = info.where(date_from_parts("year", "month", "day") <= F.lit(dt.date.fromisoformat(p.end_date)))
    info = info.select("delivery_code", json_double("quote", "$.amount").alias("amount"))
    db = t["delivery_booking"].where(not_blank("booking_code") & (F.col("year") == p.year)).select(
        "delivery_code", "booking_code"
    )
    pb = t["bookings"].where(
        (F.col("year") == p.year) & has_prefix("code", PARTNER) & (F.col("is_unique_booking") == "t")
    ).select("code", "fare")
    return (
        info.join(db, "delivery_code")
        .join(pb, db["booking_code"] == pb["code"])
        .select(
            "booking_code",
            F.coalesce(F.col("amount"), F.col("fare"), F.lit(0.0)).alias("pax_Fare"),
        )
        .distinct()
    )


# --- step 2/3: booking -> invoice ------------------------------------------------------

def booking_invoice(t: dict, p: MartParams) -> DataFrame:
    """B3 (steps 2-3): booking/delivery pairs from two sources joined to invoices from three."""
    db, ev = t["delivery_booking"], t["express_event"]
    pairs = union_distinct(
        [
            db.where(F.col("booking_code").isNotNull() & F.col("delivery_code").isNotNull() & (F.col("year") == p.year))
            .select("delivery_code", "booking_code"),
            ev.where(F.col("orderid").isNotNull() & F.col("bookingcode").isNotNull() & (F.col("year") == p.year))
            .select(F.col("orderid").alias("delivery_code"), F.col("bookingcode").alias("booking_code")),
        ]
    )
    invoices = union_distinct(
        [
            t["delivery_info"].where(json_text("metadata", "$.invoiceNo").isNotNull() & (F.col("year") == p.year))
            .select("delivery_code", json_text("metadata", "$.invoiceNo").alias("invoice_number")),
            t["order_merchant_order_relations"].select(
                F.col("order_id").alias("delivery_code"), F.col("merchant_order_id").alias("invoice_number")
            ),
            db.where(F.col("year") == p.year).select(
                "delivery_code", json_text("metadata", "$.merchantOrderID").alias("invoice_number")
            ),
        ]
    )
    # The source's LEFT JOIN is made inner by its WHERE on invoice_number.
    return (
        pairs.join(invoices, "delivery_code")
        .where(not_blank("invoice_number") & not_blank("booking_code"))
        .select("booking_code", "delivery_code", "invoice_number")
        .distinct()
    )


# --- step 4/5: booking -> service type -------------------------------------------------

def service_type_map(t: dict, p: MartParams, express_types: DataFrame) -> DataFrame:
    """B4 (steps 4-5): largest service-type code per booking over three sources."""
    # Parsed once at the scan; the metadata text goes no further.
    bs = (
        t["booking_service"]
        .where(date_from_parts("year", "month", "day") > F.lit(dt.date.fromisoformat(p.service_after)))
        .select("booking_code", "vehicle_type_id", json_int("metadata", "$.expressMeta.jobCard.jobType").alias("service_type"))
        .where(F.col("service_type").isNotNull())
    )
    from_meta = bs.join(express_types, bs["vehicle_type_id"] == express_types["taxi_type_id"], "left_semi").select(
        "booking_code", "service_type"
    )
    from_delivery = t["delivery_booking"].where(F.col("year") == p.year).select("booking_code", "service_type")
    label = F.col("servicetype")
    code = F.lit(-1)
    for name, value in reversed(list(SERVICE_CODES.items())):
        code = F.when(label == name, F.lit(value)).otherwise(code)
    from_events = t["express_event"].select(F.col("bookingcode").alias("booking_code"), code.alias("service_type"))
    return max_per_key([from_meta, from_delivery, from_events], "booking_code", "service_type")


# --- step 14: booking -> partner id ----------------------------------------------------

def merchant_mapping(t: dict, p: MartParams) -> DataFrame:
    """B5 (step 14): partner id from the delivery user, else from the booking code.

    One row per booking x vehicle-type version x delivery row (no de-duplication,
    as in the source).
    """
    bk = t["bookings"].where(
        has_prefix("code", PARTNER) & (F.col("year") == p.year) & (F.col("partition_date") > p.mapping_after)
    ).select("code", "taxi_type_id")
    ttv = t["taxi_types"].select(F.col("id").alias("_ttv_id"))
    db = t["delivery_booking"].select("booking_code", "user_id")
    return (
        bk.join(ttv, bk["taxi_type_id"] == ttv["_ttv_id"])
        .join(db, db["booking_code"] == bk["code"], "left")
        .select(
            "code",
            F.coalesce(F.col("user_id").cast("string"), F.trim(split_part("code", "-", 2))).alias("partner_id"),
        )
    )


# --- step 6/7: daily metrics cube --------------------------------------------------------

def _flags(state: Column) -> dict[str, Column]:
    return {
        "RIDE": state.isin(*RIDE_STATES),
        "CXL": state.isin(*CANCELLED_STATES),
        "CXL_PAX": state == "CANCELLED_PASSENGER",
        "CXL_OPS": state == "CANCELLED_OPERATOR",
        "CXL_DAX": state == "CANCELLED_DRIVER",
        "ALLOC": ~state.isin(UNALLOCATED_STATE),
        "UNALLOC": state == UNALLOCATED_STATE,
    }


def service_label(service_type: Column, code: Column) -> Column:
    """Service-type label; order of the branches matters."""
    out = F.when(has_prefix(code, PARTNER), F.lit("unmapped")).otherwise(F.lit("APP"))
    for value, label in reversed(list(SERVICE_LABELS.items())):
        out = F.when(service_type == value, F.lit(label)).otherwise(out)
    return out


def with_month_rate(df: DataFrame, rates: DataFrame, country: str, day: Column) -> DataFrame:
    """Attach ``exchange_one_usd`` of the booking's country and month.

    The month key is computed on both sides so the join is an equi-join on
    (country, month); several rate rows in one month repeat the booking, as in the source.
    """
    r = rates.select(
        F.col("country_id").alias("_rate_country"),
        month_start(F.col("end_date")).alias("_rate_month"),
        "exchange_one_usd",
    )
    return df.join(
        r,
        (df[country] == r["_rate_country"]) & (month_start(day) == r["_rate_month"]),
        "left",
    ).drop("_rate_country", "_rate_month")


def area_lookup(t: dict) -> DataFrame:
    """Area map with polygon centroids (A11) attached by (country, city, area)."""
    am = t["area_map"]
    centroids = (
        t["polygon_boundaries"].groupBy("country_id", "city_id", "area")
        .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    )
    return am.join(centroids, ["country_id", "city_id", "area"], "left").select(
        *[am[c] for c in am.columns if c not in ("latitude", "longitude")], centroids["latitude"], centroids["longitude"]
    )


def named_mapping(d: dict, t: dict) -> DataFrame:
    """Merchant mapping with the merchant name attached (keyed by booking code).

    Joining the merchants to the mapping before the bookings keeps every later
    join of the bookings on the booking code (left joins are associative here:
    the merchants' condition only reads mapping columns).
    """
    mm = d["merchant_mapping"].select(F.col("code").alias("_mm_code"), "partner_id")
    merchants = t["merchants"].select(F.col("merchant_id").cast("string").alias("_m_id"), "merchant_name")
    return mm.join(merchants, mm["partner_id"] == merchants["_m_id"], "left").select("_mm_code", "merchant_name")


def stored_aside(df: DataFrame) -> DataFrame:
    """``df`` written to a folder of its own, removed when the application ends, and a scan of it: its size is known then."""
    folder = new_run_dir(df.sparkSession)
    delete_at_end(df.sparkSession, folder)
    return write_table(df, f"{folder}/aside")


def booking_facts(t: dict, p: MartParams, d: dict) -> DataFrame:
    """What the cube reads of each booking, with everything that joins by another key than the booking code.

    The joins on type, id, area and month read booking columns only, so they
    commute with those on the code, and run while each booking is one row. The
    source joins the type table twice (inner, then left with the validity test)
    and uses neither copy's columns: a booking counts (versions of its type) x
    (versions that hold ``created_at_local``) times. Both numbers come from
    ``with_valid_counts``; bookings of other families or without a valid
    version drop out.

    ``join_code`` is the key of the joins on the code: the code; for a NULL
    code one that matches nothing, spread by id; for a code above
    ``hot_share`` of the bookings (``is_hot``), the code salted by id.
    Finding those is a counting pass that runs when this function is called,
    and the steps of the types' validity are written then: joined by a size that
    Spark would only guess, they had all bookings shuffled by type and day.
    """
    since = day_before(p.metrics_from)
    bk = t["bookings"].where(
        ~F.col("country_id").isin(*p.excluded_countries)
        & (F.col("partition_date") >= since)
        & (F.col("date_local") >= p.metrics_from)
    ).select(
        "id", "code", "fare", "is_unique_booking", "taxi_type_id", "hour_local", "country_name", "city_name",
        "country_id", "city_id", "date_local", "state", "distance", "commission", "pickup_geohash",
        "partition_date", "created_at_local",
    )
    hot = hot_values(bk, "code", p.hot_share)
    versions = d["express_taxi_types"].select(F.col("taxi_type_id").alias("key"), F.col("start_at").alias("start"), F.col("end_at").alias("end"))
    rows = with_valid_counts(bk, versions, "taxi_type_id", "created_at_local", store=stored_aside).where(F.col("n_valid") > 0)
    ub = t["unique_bookings"].where(parts_text("year", "month", "day") >= since).select(
        "last_id", "first_at", "first_allocated"
    )
    rows = rows.join(ub, F.col("id") == ub["last_id"], "left")
    # The area alone: the centroids, one row for each place at most, neither add nor drop rows.
    area = t["area_map"].select(
        F.col("geohash").alias("_a_geohash"), F.col("city_id").alias("_a_city"),
        F.col("country_id").alias("_a_country"), "area",
    )
    rows = rows.join(
        area,
        (area["_a_geohash"] == F.col("pickup_geohash"))
        & (area["_a_city"] == F.col("city_id"))
        & (area["_a_country"] == F.col("country_id")),
        "left",
    )
    rows = with_month_rate(rows, t["exchange_rates"], "country_id", F.to_date(F.col("date_local")))
    code = F.col("code")
    join_code = F.when(is_hot(code, hot), salted_key(code, F.col("id"))).otherwise(spread_null_key(code, F.col("id")))
    return rows.select(
        join_code.alias("join_code"), is_hot(code, hot).alias("is_hot"), "code", "fare", "is_unique_booking", "hour_local", "country_name",
        "city_name", "date_local", "state", "distance", "commission", "partition_date", "first_at", "first_allocated", "area",
        "exchange_one_usd", "n_versions", "n_valid",
    )


def cube_merchants(t: dict, p: MartParams, d: dict) -> DataFrame:
    """Merchant names by booking code, identical rows as one with their number (``copies``)."""
    return weighted_distinct(named_mapping(d, t).withColumnRenamed("_mm_code", "code"), "code", "copies")


def cube_candidates(t: dict, p: MartParams, d: dict) -> DataFrame:
    """Won candidates of the delivery family by booking code, identical rows as one with their number (``copies``)."""
    ttv = t["taxi_types"].where(F.col("taxi_type_simple") == p.type_family).select(F.col("id").cast("string").alias("_ttv_id"))
    since = day_before(p.metrics_from)
    cm = t["candidate_metadata"].where((F.col("winner") == "true") & (F.col("partition_date") >= since))
    # Candidates count on their booking's date only; the dates of the cube's bookings prune the folders of the others at run time.
    dates = t["bookings"].where((F.col("partition_date") >= since) & (F.col("date_local") >= p.metrics_from)).select("partition_date").distinct()
    cm = cm.join(dates, "partition_date", "left_semi")
    won = cm.join(ttv, F.col("vehicle_type_id") == F.col("_ttv_id")).select(
        "booking_code", "partition_date", "awarded_time", "cancel_passenger_time", "cancel_driver_time", "cancel_operator_time"
    )
    return weighted_distinct(won, "booking_code", "copies")


def _cube_sides(t: dict, p: MartParams, d: dict) -> list[tuple[DataFrame, str, str | None]]:
    """What joins the bookings by their code: frame, key, and the column that counts identical rows, if any."""
    since = day_before(p.metrics_from)
    bs = d["service_type_map"].select(F.col("booking_code").alias("_bs_code"), "service_type")
    pf = d["pax_fares"].select(F.col("booking_code").alias("_pf_code"), "pax_Fare")
    incentive = (
        t["incentive_payouts"].where(F.col("date_partition") >= since)
        .groupBy(F.col("booking_code").alias("_inc_code"))
        .agg(F.sum("payout_per_ride").alias("incentive_payout"))
    )
    mm = d["cube_merchants"].select(F.col("code").alias("_mm_code"), "merchant_name", F.col("copies").alias("_w_mm"))
    bi = d["booking_invoice"].select(F.col("booking_code").alias("_bi_code"))
    rec = t["receipts"].where(parts_text("year", "month", "day") >= since).select(
        F.col("booking_code").alias("_rec_code"), "tolls_and_surcharges", "booking_fee"
    )
    promo = t["promo_bookings"].where(
        F.col("date_local") >= F.to_timestamp(F.lit(p.metrics_from), "yyyy-MM-dd")
    ).select(F.col("code").alias("_promo_code"), "promo_expense_local", F.lit(True).alias("promo"))
    cm = d["cube_candidates"].withColumnsRenamed({"booking_code": "_cm_code", "partition_date": "_cm_pdate", "copies": "_w_cm"})
    # Sides unique per booking join as they are; sides that may hold identical
    # rows are collapsed to distinct rows with a count that joins the weight.
    return [
        (bs, "_bs_code", None), (pf, "_pf_code", None), (incentive, "_inc_code", None), (mm, "_mm_code", "_w_mm"),
        (weighted_distinct(bi, "_bi_code", "_w_bi"), "_bi_code", "_w_bi"), (weighted_distinct(rec, "_rec_code", "_w_rec"), "_rec_code", "_w_rec"),
        (weighted_distinct(promo, "_promo_code", "_w_promo"), "_promo_code", "_w_promo"), (cm, "_cm_code", "_w_cm"),
    ]


def _with_cube_sides(rows: DataFrame, tests: DataFrame, sides: list) -> DataFrame:
    """Bookings that are no test, with every side joined by ``join_code`` and the sides' counts in ``weight``."""
    rows = anti(rows, tests, F.col("join_code") == F.col("_tb_code"))
    for side, key, copies in sides:
        on = F.col("join_code") == F.col(key)
        if key == "_cm_code":
            # Residual (not a join key): keeps this join on the code's partitioning.
            on = on & F.coalesce(F.col("partition_date") == F.col("_cm_pdate"), F.lit(False))
        rows = rows.join(side, on, "left")
        if copies:
            rows = rows.withColumn("weight", F.col("weight") * F.coalesce(F.col(copies), F.lit(1)))
    return rows


def daily_metrics(t: dict, p: MartParams, d: dict) -> DataFrame:
    """B7 (steps 6-7): 10 keys x 64 conditional measures, one aggregation pass.

    ``d`` holds the derived tables: booking_facts, cube_merchants,
    cube_candidates, service_type_map, booking_invoice, pax_fares.

    All joins are on ``join_code``, one after the other. Over stored steps and
    sources clustered by the code they shuffle nothing, nor do the counts of
    identical rows in front of them; the one shuffle is the aggregation's.
    Bookings of hot codes (at most 1/``hot_share`` codes, named by the facts)
    take the same joins with salted copies of the sides' rows of those codes.
    The sums are weighted by the number of times that a row stands for itself.
    """
    weight = F.col("n_valid") if p.single_type_join else F.col("n_versions") * F.col("n_valid")
    facts = d["booking_facts"].withColumn("weight", weight).drop("n_versions", "n_valid")
    sides = _cube_sides(t, p, d)
    tests = t["test_bookings"].select(F.col("code").alias("_tb_code"))
    hot = [r.code for r in facts.where("is_hot").select("code").distinct().collect()]
    if not hot:
        return cube_from_rows(_with_cube_sides(facts, tests, sides), weight=F.col("weight"), strict=p.on_error == "fail")
    cold = [(side.where(~is_hot(F.col(key), hot)), key, copies) for side, key, copies in sides]
    warm = [(salted_copies(side.where(is_hot(F.col(key), hot)), key, key), key, copies) for side, key, copies in sides]
    warm_tests = salted_copies(tests.where(is_hot(F.col("_tb_code"), hot)).distinct(), "_tb_code", "_tb_code")
    rows = _with_cube_sides(facts.where("NOT is_hot"), tests.where(~is_hot(F.col("_tb_code"), hot)), cold)
    rows = rows.unionByName(_with_cube_sides(facts.where("is_hot"), warm_tests, warm))
    return cube_from_rows(rows, weight=F.col("weight"), strict=p.on_error == "fail")


def cube_from_rows(rows: DataFrame, weight: Column | None = None, strict: bool = True) -> DataFrame:
    """The aggregation of B7 over the joined booking rows (one pass, 64 sums).

    ``weight`` is the number of times each row stands for itself (the
    multiplicity of joins that only repeat rows); every sum is weighted by it.
    """
    state = F.col("state")
    ub = F.col("is_unique_booking") == "t"
    promo = F.col("promo") == F.lit(True)
    flags = {"UB": ub, "FA": F.col("first_allocated") == "t", "PROMO": promo,
             "AWARDED": F.col("awarded_time").isNotNull(), **_flags(state)}
    x = F.col("exchange_one_usd")
    fare, dist = F.col("fare"), F.col("distance")
    tolls, fee = F.col("tolls_and_surcharges"), F.col("booking_fee")
    zero = F.lit(0.0)
    awarded = F.col("awarded_time")
    cancel = F.lit(0).cast("bigint")
    for c in ("cancel_operator_time", "cancel_driver_time", "cancel_passenger_time"):
        cancel = F.when(awarded.isNotNull() & F.col(c).isNotNull(), elapsed_seconds(awarded, F.col(c))).otherwise(cancel)
    measures = {
        "ONE": F.lit(1).cast("bigint"),
        "FARE0": F.coalesce(fare, zero),
        "FARE": fare,
        "PAX_FARE": F.coalesce(F.col("pax_Fare"), fare),
        "FARE_USD0": F.coalesce(per_rate(fare, x), zero),
        "PAX_FARE_USD0": F.coalesce(F.coalesce(per_rate(F.col("pax_Fare"), x), per_rate(fare, x)), zero),
        "DIST0": F.coalesce(dist, zero),
        "DIST": dist,
        "GMV": F.coalesce(tolls, zero) + F.coalesce(fare, zero) + F.coalesce(fee, zero),
        "GMV_USD": F.coalesce(per_rate(tolls, x), zero) + F.coalesce(per_rate(fare, x), zero)
        + F.coalesce(per_rate(fee, x), zero),
        "SECS_TO_AWARD": elapsed_seconds(parse_ts(F.col("first_at"), strict), awarded),
        "SECS_TO_CANCEL": cancel,
        "COMMISSION0": F.coalesce(F.col("commission"), zero),
        "PROMO_EXPENSE0": F.coalesce(F.col("promo_expense_local"), zero),
        "INCENTIVE0": F.coalesce(F.col("incentive_payout"), zero),
        "COMMISSION_USD0": F.coalesce(per_rate(F.col("commission"), x), zero),
        "PROMO_EXPENSE_USD0": F.coalesce(per_rate(F.col("promo_expense_local"), x), zero),
        "INCENTIVE_USD0": F.coalesce(per_rate(F.col("incentive_payout"), x), zero),
    }
    keys = [
        F.col("hour_local").cast("int").alias("hour_local"),
        F.coalesce(F.col("merchant_name"), F.lit("Unknown")).alias("merchant_name"),
        F.col("country_name").alias("country"),
        F.col("city_name").alias("city"),
        strip_digits(F.coalesce(F.col("area"), F.lit("Other Areas"))).alias("pickup_area"),
        week_start(F.to_date(F.col("date_local"))).alias("week_local"),
        F.when(ub & promo, F.lit(1)).otherwise(F.lit(0)).alias("promo_ride"),
        F.when(has_prefix("code", PARTNER), F.lit(1)).otherwise(F.lit(0)).alias("api_flag"),
        service_label(F.col("service_type"), F.col("code")).alias("service_type"),
        F.to_date(F.col("date_local")).alias("date_local"),
    ]
    # Measures stay inside their CASE so they are evaluated only on hits (a
    # strict parse must not fail on rows the predicate excludes); repeated
    # predicates and measures are shared by codegen's common-subexpression pass.
    if weight is not None:
        measures = {k: (weight.cast("bigint") if k == "ONE" else m * weight) for k, m in measures.items()}
    aggs = []
    for name, pred_keys, measure_key, otherwise in METRICS:
        pred = None
        if pred_keys:
            pred = flags[pred_keys[0]]
            for k in pred_keys[1:]:
                pred = pred & flags[k]
        agg = conditional_sum(pred, measures[measure_key], otherwise_zero=(otherwise == "0"))
        if measure_key in COUNT_MEASURES:
            agg = agg.cast("bigint")
        aggs.append(agg.alias(name))
    return rows.groupBy(*keys).agg(*aggs)


# --- step 8/9: attempts per invoice ---------------------------------------------------

# Columns of the delivery's timeline and their keys in its JSON text.
TIMELINE = {"allocation_time": "allocate", "pickup_time": "pickup", "dropoff_time": "dropoff", "fail_time": "fail"}

def _partner_bookings(t: dict, p: MartParams, types: DataFrame, columns: list[str]) -> DataFrame:
    """Partner bookings of the delivery family from ``attempts_from`` on.

    The source inner-joins the type table, whose columns are unused and whose
    repeats are removed by a later de-duplication, so it is a semi join here.
    """
    bk = t["bookings"].where(has_prefix("code", PARTNER) & (F.col("partition_date") >= p.attempts_from)).select(
        *columns
    )
    ids = types.select(F.col("taxi_type_id").alias("_ge_id"))
    return bk.join(ids, bk["taxi_type_id"] == ids["_ge_id"], "left_semi")


def deliveries(t: dict, p: MartParams, d: dict) -> DataFrame:
    """Delivery rows of ``year`` with an info row of ``year``: quoted amount and timeline, by booking code.

    Each JSON text is parsed once, at its scan, and goes no further.
    """
    timeline = json_fields("timeline", list(TIMELINE.values()))
    db = t["delivery_booking"].where((F.col("year") == p.year) & F.col("booking_code").isNotNull()).select(
        "booking_code", F.col("delivery_code").alias("_db_delivery"), timeline.alias("at")
    )
    db = db.select("booking_code", "_db_delivery", *[parse_iso_z(F.col("at")[key]).alias(name) for name, key in TIMELINE.items()])
    info = t["delivery_info"].where(F.col("year") == p.year).select(
        F.col("delivery_code").alias("_i_code"), json_double("quote", "$.amount").alias("amount")
    )
    return db.join(info, db["_db_delivery"] == info["_i_code"]).select("booking_code", "amount", *TIMELINE)


def partner_invoices(t: dict, p: MartParams, d: dict) -> DataFrame:
    """Partner bookings with their invoices (a row each, NULL without one) and ``is_test``: read by steps 8 and 10."""
    b = _partner_bookings(
        t, p, d["express_taxi_types"],
        ["code", "state", "created_at", "distance", "fare", "commission", "pick_up_time_local", "country_name",
         "city_name", "date_local", "country_id", "taxi_type_id", "hour_local", "is_unique_booking"],
    )
    bi = d["booking_invoice"].select(F.col("booking_code").alias("_bi_code"), "invoice_number")
    tests = t["test_bookings"].select(F.col("code").alias("_tb_code")).distinct()
    rows = b.join(bi, F.col("code") == bi["_bi_code"], "inner" if p.drop_unmapped else "left").drop("_bi_code")
    rows = rows.join(tests, F.col("code") == F.col("_tb_code"), "left")
    return rows.withColumn("is_test", F.col("_tb_code").isNotNull()).drop("_tb_code")


def attempts_per_invoice(t: dict, p: MartParams, d: dict) -> DataFrame:
    """B8 (steps 8-9): distinct booking codes and distinct unique codes per invoice.

    The source's test-booking join is vacuous (it matches only NULL codes), so
    test bookings are counted; ``exclude_test_in_attempts`` removes them.
    Distinct counts are two aggregations: per (invoice, code), then per invoice.
    """
    rows = d["partner_invoices"]
    if p.exclude_test_in_attempts:
        rows = rows.where(~F.col("is_test"))
    rows = rows.select("invoice_number", "code", "is_unique_booking").join(
        d["deliveries"].select("booking_code"), F.col("code") == F.col("booking_code"), "left_semi"
    )
    per_code = rows.groupBy("invoice_number", "code").agg(
        F.max(F.col("is_unique_booking") == "t").alias("_ub")
    )
    return per_code.groupBy("invoice_number").agg(
        F.count("code").alias("non_UB"),
        F.count(F.when(F.col("_ub"), F.col("code"))).alias("unique_bookings"),
    )


# --- step 10/11: invoice summary ------------------------------------------------------

# The output columns of the last attempt and the keys of the summary.
FINAL_COLUMNS = [
    "invoice_number", "booking_code", "state", "created_at", "distance", "dax_fare", "dax_fare_usd",
    "pax_fare", "pax_fare_usd", "commission", "pick_up_time_local", "country_name", "city_name",
    "date_local", "merchant_name", "service_type", "allocation_time", "pickup_time", "dropoff_time",
    "fail_time",
]

SUMMARY_KEYS = [
    "non_UB", "unique_bookings", "final_invoice_state", "time_to_allocate", "time_to_pick", "time_to_drop",
    "time_to_allocate1", "time_to_pick1", "time_to_drop1", "time_to_fail", "tt_allocate", "country_name",
    "city_name", "date_local", "merchant_name", "service_type", "distance", "invoice_hour_local",
]


def last_attempts(t: dict, p: MartParams, d: dict) -> DataFrame:
    """Per invoice, the latest attempt (by ``created_at`` text, NULL last).

    Ties on ``created_at`` resolve by booking code, then by the other columns.
    """
    rows = d["partner_invoices"].where(~F.col("is_test")).drop("is_test", "is_unique_booking", "hour_local", "taxi_type_id")
    delivered = d["deliveries"].withColumnRenamed("booking_code", "_db_code")
    # The winner of an invoice is found on three columns; LEFT JOINs made inner by
    # the source's WHERE on booking.year and info.year ask that its code was delivered.
    keys = rows.select("invoice_number", "created_at", F.col("code").alias("booking_code")).join(
        delivered.select("_db_code"), F.col("booking_code") == F.col("_db_code"), "left_semi"
    )
    winners = top1_per_group(keys, "invoice_number", [F.col("created_at"), F.col("booking_code")], descending=True)
    winners = winners.select(F.col("invoice_number").alias("_w_invoice"), F.col("created_at").alias("_w_created"), F.col("booking_code").alias("_w_code"))
    won = F.col("invoice_number").eqNullSafe(F.col("_w_invoice")) & F.col("created_at").eqNullSafe(F.col("_w_created"))
    rows = rows.join(winners, (F.col("code") == F.col("_w_code")) & won, "left_semi")
    # Only winners meet the wide sides.
    mm = d["cube_merchants"].select(F.col("code").alias("_mm_code"), "merchant_name")
    bs = d["service_type_map"].select(F.col("booking_code").alias("_bs_code"), "service_type")
    for right, key in ((mm, "_mm_code"), (bs, "_bs_code")):
        rows = rows.join(right, F.col("code") == right[key], "left")
    rows = rows.join(delivered, F.col("code") == delivered["_db_code"])
    rows = with_month_rate(rows, t["exchange_rates"], "country_id", F.to_date(F.col("date_local")))
    x, fare, amount = F.col("exchange_one_usd"), F.col("fare"), F.col("amount")
    candidates = rows.select(
        "invoice_number",
        F.col("code").alias("booking_code"),
        "state",
        "created_at",
        "distance",
        fare.alias("dax_fare"),
        F.coalesce(per_rate(fare, x), F.lit(0.0)).alias("dax_fare_usd"),
        F.coalesce(amount, fare).alias("pax_fare"),
        F.coalesce(per_rate(amount, x), per_rate(fare, x)).alias("pax_fare_usd"),
        "commission",
        "pick_up_time_local",
        "country_name",
        "city_name",
        "date_local",
        "merchant_name",
        "service_type",
        *TIMELINE,
    )
    # A winner may have several rows still (quotes, rates, merchants): the largest
    # by the other columns, among few rows of one code and invoice. Equal rows
    # give the same choice, so the source's DISTINCT is not needed.
    return top1_per_group(candidates, ["booking_code", "invoice_number"], [F.col("created_at")],
                          descending=True, columns=[c for c in FINAL_COLUMNS if c not in ("booking_code", "invoice_number")]).select(*FINAL_COLUMNS)


def first_attempts(t: dict, p: MartParams, d: dict) -> DataFrame:
    """Per invoice, the earliest attempt (by ``created_at`` text, NULL last)."""
    rows = d["partner_invoices"].where(~F.col("is_test")).select(
        "invoice_number", F.col("code").alias("booking_code"), "created_at",
        F.col("hour_local").alias("invoice_hour_local"),
    )  # no DISTINCT needed before the top-1 (see last_attempts)
    first = top1_per_group(rows, "invoice_number", [F.col("created_at"), F.col("booking_code")],
                           descending=False, columns=["booking_code", "created_at", "invoice_hour_local"])
    return first.select(
        "invoice_number",
        F.col("booking_code").alias("first_booking_code"),
        parse_ts_dropping_millis("created_at", strict=p.on_error == "fail").alias("first_time_stamp"),
        "invoice_hour_local",
    )


def invoice_summary(t: dict, p: MartParams, d: dict) -> DataFrame:
    """B9 (steps 10-11): last attempt + first attempt + attempt counts, summarised.

    Durations are whole minutes (integer division of elapsed seconds by 60):
    from the first booking for time_to_allocate(1), time_to_pick1,
    time_to_drop1, time_to_fail and tt_allocate; from allocation for
    time_to_pick and time_to_drop. ``date_local`` is the first attempt's date.

    Each input of the final join has one row per invoice (the NULL invoice
    included), so the source's 24-column de-duplication is a no-op and
    ``COUNT(DISTINCT invoice_number)`` equals ``COUNT(invoice_number)``.
    """
    last = last_attempts(t, p, d).select(
        "invoice_number",
        F.col("state").alias("final_invoice_state"),
        "distance",
        parse_ts_dropping_millis("created_at", strict=False).alias("created_at"),
        "dax_fare", "dax_fare_usd", "pax_fare", "pax_fare_usd",
        "allocation_time", "pickup_time", "dropoff_time", "fail_time",
        "country_name", "city_name", "merchant_name", "service_type",
    )
    counts = d["attempts_per_invoice"].select(F.col("invoice_number").alias("_t1_invoice"), "non_UB",
                                              "unique_bookings")
    first = first_attempts(t, p, d).select(F.col("invoice_number").alias("_fs_invoice"), "first_time_stamp",
                                           "invoice_hour_local")
    wrap = (
        last.join(counts, last["invoice_number"] == counts["_t1_invoice"], "left")
        .join(first, F.col("invoice_number") == first["_fs_invoice"], "left")
    )
    start, alloc = F.col("first_time_stamp"), F.col("allocation_time")
    wrap = wrap.select(
        "invoice_number", "final_invoice_state", "invoice_hour_local",
        whole_minutes(start, alloc).alias("time_to_allocate"),
        whole_minutes(alloc, F.col("pickup_time")).alias("time_to_pick"),
        whole_minutes(alloc, F.col("dropoff_time")).alias("time_to_drop"),
        whole_minutes(start, alloc).alias("time_to_allocate1"),
        whole_minutes(start, F.col("pickup_time")).alias("time_to_pick1"),
        whole_minutes(start, F.col("dropoff_time")).alias("time_to_drop1"),
        whole_minutes(start, F.col("fail_time")).alias("time_to_fail"),
        whole_minutes(start, F.col("created_at")).alias("tt_allocate"),
        "non_UB", "unique_bookings", "dax_fare", "dax_fare_usd", "pax_fare", "pax_fare_usd",
        "country_name", "city_name", F.to_date(start).alias("date_local"), "merchant_name", "service_type",
        "distance",
    )
    return wrap.groupBy(*SUMMARY_KEYS).agg(
        F.count("invoice_number").alias("invoices"),
        F.sum("dax_fare").alias("dax_fare"),
        F.sum("dax_fare_usd").alias("dax_fare_usd"),
        F.sum("pax_fare").alias("pax_fare"),
        F.sum("pax_fare_usd").alias("pax_fare_usd"),
    )


# --- data quality ---------------------------------------------------------------------

# Keys that repeat a booking in the cube when a joined table holds them more than once.
CUBE_JOIN_KEYS = {
    "merchant_mapping": ["code"], "booking_invoice": ["booking_code"], "pax_fares": ["booking_code"],
    "receipts": ["booking_code"], "promo_bookings": ["code"], "unique_bookings": ["last_id"], "merchants": ["merchant_id"],
    "area_map": ["country_id", "city_id", "geohash"], "candidate_metadata": ["booking_code", "partition_date"],
}


def uniqueness_report(t: dict, d: dict) -> DataFrame:
    """Per table joined into the cube, how many keys repeat and by how many rows: what fans the bookings out."""
    parts = []
    for name, key in CUBE_JOIN_KEYS.items():
        table = d[name] if name in d else t[name]
        repeated = table.where(F.col(key[0]).isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(repeated.agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows")
        ))
    return reduce(DataFrame.unionByName, parts)
