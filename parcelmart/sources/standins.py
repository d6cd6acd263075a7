"""Stand-in source tables for the booking mart, derived from the provided tables.

The mart reads 18 source tables that the test data does not have. Each one is
derived here from the provided tables (orders, customer, nation, lineitem,
events, supplier), so its size grows with them. The derivations are written
once, in the SQL subset that both Spark SQL and DuckDB accept, so the Spark run
and the DuckDB oracle read identical inputs.

Rules that keep the comparison exact:

* money, distances and rates are dyadic (integers, halves, quarters, eighths;
  rates are powers of two), so every double SUM is exact whatever the order;
* dates are moved into 2018 by keeping month and day of the order date
  (29 February becomes the 28th);
* edge rows the mart must handle are produced by key arithmetic: NULL fares,
  malformed JSON, unpadded partition months, duplicate quotes, invoices shared
  by several bookings, zero and missing exchange rates, fractional seconds.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelmart.session import checkpoint_dir, delete_at_end
from parcelmart.sources.sinks import write_clustered, write_table
from parcelmart.sources.tables import listing, load

# Shared pieces ------------------------------------------------------------------

_DAY = "CAST(CAST(o.o_orderdate AS DATE) AS STRING)"
_HH = "lpad(CAST(k.id % 24 AS STRING), 2, '0')"
_MI = "lpad(CAST(k.id % 60 AS STRING), 2, '0')"
_SS = "lpad(CAST((k.id * 7) % 60 AS STRING), 2, '0')"
_INVOICE = "'INV-' || CAST(CAST(floor(k.id / 4) AS BIGINT) AS STRING)"


def _ts_text(minute: str, second: str, hour: str = _HH) -> str:
    return f"k.date_local || ' ' || {hour} || ':' || {minute} || ':' || {second}"


def _iso(minute_offset: int, suffix_rule: str) -> str:
    minute = f"lpad(CAST((k.id + {minute_offset}) % 60 AS STRING), 2, '0')"
    second = "lpad(CAST((k.id * 3) % 60 AS STRING), 2, '0')"
    return f"k.date_local || 'T' || {_HH} || ':' || {minute} || ':' || {second} || {suffix_rule}"


# Stand-in definitions, in dependency order. ------------------------------------

STANDIN_SQL: dict[str, str] = {}

# One row per order: booking id, code, place and 2018 date.
STANDIN_SQL["bk_keys"] = f"""
SELECT o.o_orderkey AS id,
       o.o_custkey AS custkey,
       o.o_orderstatus AS orderstatus,
       o.o_orderpriority AS orderpriority,
       o.o_totalprice AS totalprice,
       CASE WHEN o.o_orderkey % 307 = 11 THEN NULL
            WHEN o.o_orderkey % 307 = 12 THEN ''
            WHEN o.o_orderkey % 1000 = 998 THEN 'PARTNER' || CAST(o.o_orderkey AS STRING)
            WHEN o.o_orderkey % 2 = 0
              THEN 'PARTNER-' || lpad(CAST(o.o_custkey AS STRING), 8, '0') || '-' || CAST(o.o_orderkey AS STRING)
            ELSE 'APP-' || CAST(o.o_orderkey AS STRING) END AS code,
       c.c_nationkey AS country_id,
       CAST(c.c_custkey % 5 AS INT) AS city_id,
       n.n_name AS country_name,
       'CITY_' || CAST(c.c_nationkey AS STRING) || '_' || CAST(c.c_custkey % 5 AS STRING) AS city_name,
       CASE WHEN substr({_DAY}, 6, 5) = '02-29' THEN '2018-02-28'
            ELSE '2018' || substr({_DAY}, 5, 6) END AS date_local
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

STANDIN_SQL["bookings"] = f"""
SELECT k.id,
       k.code,
       CASE WHEN k.id % 50 = 7 THEN NULL ELSE CAST(floor(k.totalprice) AS DOUBLE) END AS fare,
       CASE WHEN k.id % 17 = 3 THEN '2017' ELSE '2018' END AS year,
       CASE WHEN k.orderpriority = '5-LOW' THEN 'f' ELSE 't' END AS is_unique_booking,
       CAST(k.custkey % 6 AS INT) AS taxi_type_id,
       CAST(k.id % 24 AS STRING) AS hour_local,
       k.country_name,
       k.city_name,
       CASE WHEN k.id % 101 = 50 THEN NULL ELSE k.country_id END AS country_id,
       k.city_id,
       k.date_local,
       CASE WHEN k.id % 211 = 5 THEN NULL
            WHEN k.orderstatus = 'F' AND k.id % 5 = 0 THEN 'PICKING_UP'
            WHEN k.orderstatus = 'F' THEN 'COMPLETED'
            WHEN k.orderstatus = 'O' AND k.id % 9 = 0 THEN 'ADVANCE_AWARDED'
            WHEN k.orderstatus = 'O' THEN 'UNALLOCATED'
            WHEN k.id % 3 = 0 THEN 'CANCELLED_PASSENGER'
            WHEN k.id % 3 = 1 THEN 'CANCELLED_DRIVER'
            ELSE 'CANCELLED_OPERATOR' END AS state,
       CAST(k.id % 997 AS DOUBLE) / 4 AS distance,
       CAST(floor(k.totalprice / 10) AS DOUBLE) AS commission,
       'gh' || CAST(k.custkey % 13 AS STRING) AS pickup_geohash,
       k.date_local AS partition_date,
       CAST({_ts_text(_MI, _SS)} AS TIMESTAMP) AS created_at_local,
       {_ts_text(_MI, _SS)} || CASE WHEN k.id % 2 = 0 THEN '.000' ELSE '' END AS created_at,
       {_ts_text("'59'", _SS)} || '.000' AS pick_up_time_local
FROM bk_keys k
"""

# Vehicle types with validity ranges, one for each nation: ids 0-5 with an open
# start, again from mid-year on, and from March on with an open end. Family
# 'Courier' for ids 0-3.
STANDIN_SQL["taxi_types"] = """
SELECT CAST(n_nationkey % 6 AS INT) AS id,
       n_nationkey AS country_id,
       n_regionkey AS city_id,
       'TYPE_' || CAST(n_nationkey AS STRING) AS name,
       CASE WHEN n_nationkey < 6 THEN NULL
            WHEN n_nationkey < 12 THEN CAST('2018-06-01 00:00:00' AS TIMESTAMP)
            ELSE CAST('2018-03-01 00:00:00' AS TIMESTAMP) END AS start_at,
       CASE WHEN n_nationkey < 6 THEN CAST('2018-06-01 00:00:00' AS TIMESTAMP)
            WHEN n_nationkey < 12 THEN CAST('2019-01-01 00:00:00' AS TIMESTAMP)
            ELSE NULL END AS end_at,
       CASE WHEN n_nationkey % 6 < 4 THEN 'Courier' ELSE 'Ride' END AS taxi_type_simple
FROM nation
"""

STANDIN_SQL["merchants"] = """
SELECT c_custkey AS merchant_id, c_name AS merchant_name FROM customer
"""

# One rate per (country, month) seen in the bookings; rates are powers of two,
# one is zero, one month has two month-end rows, one is missing.
STANDIN_SQL["exchange_rates"] = """
SELECT country_id,
       CAST(substr(date_local, 1, 8) || '28' AS DATE) AS end_date,
       CASE WHEN country_id = 3 AND substr(date_local, 6, 2) = '05' THEN 0.0
            ELSE power(2.0, country_id % 5) END AS exchange_one_usd
FROM (SELECT DISTINCT country_id, substr(date_local, 1, 8) || '01' AS date_local FROM bk_keys) m
WHERE NOT (country_id = 5 AND substr(date_local, 6, 2) = '07')
UNION ALL
SELECT DISTINCT country_id, CAST(substr(date_local, 1, 8) || '15' AS DATE) AS end_date, 64.0 AS exchange_one_usd
FROM bk_keys WHERE country_id = 4 AND substr(date_local, 6, 2) = '06'
"""

STANDIN_SQL["delivery_booking"] = f"""
SELECT k.code AS booking_code,
       'D' || CAST(k.id AS STRING) AS delivery_code,
       CASE WHEN k.id % 10 = 4 THEN '2017' ELSE '2018' END AS year,
       CASE WHEN k.id % 8 = 6 THEN '{{}}'
            WHEN k.id % 16 = 2 THEN '{{"merchantOrderID": ""}}'
            ELSE '{{"merchantOrderID": "' || {_INVOICE} || '"}}' END AS metadata,
       CAST(k.id % 3 AS INT) AS service_type,
       '{{"allocate": "' || {_iso(11, "CASE WHEN k.id % 7 = 2 THEN '.123Z' WHEN k.id % 5 = 1 THEN 'Z' ELSE '.000Z' END")} || '"'
         || ', "pickup": "' || {_iso(23, "'.000Z'")} || '"'
         || ', "dropoff": "' || {_iso(41, "'Z'")} || '"'
         || CASE WHEN k.orderstatus = 'P' THEN ', "fail": "' || {_iso(5, "'.000Z'")} || '"' ELSE '' END
         || '}}' AS timeline,
       CASE WHEN k.id % 3 = 0 THEN NULL ELSE k.custkey END AS user_id
FROM bk_keys k
WHERE k.id % 2 = 0
"""

# A quote for every line of the order, some malformed.
STANDIN_SQL["delivery_info"] = """
SELECT 'D' || CAST(l.l_orderkey AS STRING) AS delivery_code,
       CASE WHEN l.l_linenumber = 2 AND l.l_partkey % 10 = 0 THEN '{"amount": "abc"}'
            WHEN l.l_linenumber = 2 AND l.l_partkey % 10 = 1 THEN '{"amount": null}'
            WHEN l.l_partkey % 10 = 2 THEN '{"other": 1}'
            WHEN l.l_partkey % 10 = 3 THEN '{"amount": 12'
            ELSE '{"amount": ' || CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS STRING) || '}' END AS quote,
       CASE WHEN l.l_linenumber = 1 AND l.l_orderkey % 5 <> 0
              THEN '{"invoiceNo": "INV-' || CAST(CAST(floor(l.l_orderkey / 4) AS BIGINT) AS STRING) || '"}'
            ELSE '{"note": "x"}' END AS metadata,
       CASE WHEN l.l_orderkey % 9 = 0 AND l.l_linenumber = 2 THEN '2017' ELSE '2018' END AS year,
       CASE WHEN l.l_orderkey % 2 = 0 THEN CAST(month(l.l_shipdate) AS STRING)
            ELSE lpad(CAST(month(l.l_shipdate) AS STRING), 2, '0') END AS month,
       CASE WHEN month(l.l_shipdate) = 2 AND day(l.l_shipdate) = 29 THEN '28' ELSE CAST(day(l.l_shipdate) AS STRING) END AS day
FROM lineitem l
"""

STANDIN_SQL["express_event"] = """
SELECT 'D' || CAST(k.id AS STRING) AS orderid,
       k.code AS bookingcode,
       CASE e.event_type WHEN 'click' THEN 'INSTANT' WHEN 'view' THEN 'SAME_DAY'
                         WHEN 'error' THEN NULL ELSE 'OTHER' END AS servicetype,
       CASE WHEN e.event_id % 10 = 7 THEN '2017' ELSE '2018' END AS year
FROM events e
JOIN bk_keys k ON k.id = e.event_id
"""

STANDIN_SQL["order_merchant_order_relations"] = f"""
SELECT 'D' || CAST(k.id AS STRING) AS order_id,
       CASE WHEN k.id % 9 = 3 THEN '' WHEN k.id % 9 = 6 THEN NULL ELSE {_INVOICE} END AS merchant_order_id
FROM bk_keys k
WHERE k.id % 3 = 0
"""

# Booking service records with a nested job type (missing or fractional for some).
STANDIN_SQL["booking_service"] = """
SELECT k.code AS booking_code,
       CASE WHEN k.id % 16 = 0 THEN '{"expressMeta": {"jobCard": {}}}'
            WHEN k.id % 16 = 4 THEN '{"expressMeta": {"jobCard": {"jobType": 1.5}}}'
            ELSE '{"expressMeta": {"jobCard": {"jobType": ' || CAST(CAST(floor(k.id / 4) AS BIGINT) % 3 AS STRING) || '}}}'
       END AS metadata,
       CAST(k.custkey % 6 AS INT) AS vehicle_type_id,
       '2018' AS year,
       substr(k.date_local, 6, 2) AS month,
       substr(k.date_local, 9, 2) AS day
FROM bk_keys k
WHERE k.id % 4 = 0
"""

STANDIN_SQL["receipts"] = """
SELECT k.code AS booking_code,
       CAST(k.id % 13 AS DOUBLE) AS tolls_and_surcharges,
       CASE WHEN k.id % 7 = 0 THEN NULL ELSE CAST(k.id % 5 AS DOUBLE) / 2 END AS booking_fee,
       '2018' AS year,
       CASE WHEN k.id % 2 = 1 THEN CAST(CAST(substr(k.date_local, 6, 2) AS INT) AS STRING)
            ELSE substr(k.date_local, 6, 2) END AS month,
       substr(k.date_local, 9, 2) AS day
FROM bk_keys k
WHERE k.id % 5 <> 0
"""

STANDIN_SQL["unique_bookings"] = f"""
SELECT k.id AS last_id,
       CASE WHEN k.id % 50 = 11 THEN NULL
            ELSE {_ts_text("lpad(CAST((k.id + 50) % 60 AS STRING), 2, '0')", "'00'")} END AS first_at,
       CASE WHEN k.id % 4 = 1 THEN 'f' ELSE 't' END AS first_allocated,
       '2018' AS year,
       substr(k.date_local, 6, 2) AS month,
       substr(k.date_local, 9, 2) AS day
FROM bk_keys k
WHERE k.id % 3 <> 2
"""

STANDIN_SQL["unique_bookings_new"] = """
SELECT k.id AS booking_id FROM bk_keys k WHERE k.id % 2 = 0
"""

STANDIN_SQL["promo_bookings"] = """
SELECT k.code,
       CAST(k.id % 40 AS DOUBLE) / 8 AS promo_expense_local,
       CAST(k.date_local AS DATE) AS date_local
FROM bk_keys k
WHERE k.id % 7 = 0
"""

STANDIN_SQL["incentive_payouts"] = """
SELECT k.code AS booking_code,
       CAST(l.l_linenumber AS DOUBLE) / 2 AS payout_per_ride,
       k.date_local AS date_partition
FROM lineitem l
JOIN bk_keys k ON k.id = l.l_orderkey
"""

_AREA = """CASE (s_suppkey % 65) % 3 WHEN 0 THEN 'Harbour'
                WHEN 1 THEN 'Old Town 2'
                ELSE 'Airport T' || CAST(s_suppkey % 65 AS STRING) END"""

STANDIN_SQL["area_map"] = f"""
SELECT DISTINCT s_nationkey AS country_id,
       CAST(s_suppkey % 5 AS INT) AS city_id,
       {_AREA} AS area,
       'gh' || CAST(s_suppkey % 13 AS STRING) AS geohash
FROM supplier
"""

STANDIN_SQL["polygon_boundaries"] = f"""
SELECT s_nationkey AS country_id,
       CAST(s_suppkey % 5 AS INT) AS city_id,
       {_AREA} AS area,
       CAST(s_suppkey % 64 AS DOUBLE) / 4 - 8 AS latitude,
       CAST(s_suppkey % 32 AS DOUBLE) / 8 + 100 AS longitude
FROM supplier
"""

# Codes flagged as test bookings; every 22nd appears twice.
STANDIN_SQL["test_bookings"] = """
SELECT k.code FROM bk_keys k WHERE k.id % 11 = 0
UNION ALL
SELECT k.code FROM bk_keys k WHERE k.id % 22 = 0
"""

STANDIN_SQL["candidate_metadata"] = f"""
SELECT k.code AS booking_code,
       CASE WHEN k.id % 9 = 0 THEN NULL
            ELSE CAST({_ts_text("lpad(CAST((k.id + 13) % 60 AS STRING), 2, '0')",
                                "lpad(CAST((k.id * 11) % 60 AS STRING), 2, '0')")}
                      || CASE WHEN k.id % 4 = 2 THEN '.5' ELSE '' END AS TIMESTAMP) END AS awarded_time,
       CASE WHEN k.id % 5 = 0 THEN CAST({_ts_text("'58'", "'30'")} AS TIMESTAMP) END AS cancel_passenger_time,
       CASE WHEN k.id % 7 = 0 THEN CAST({_ts_text("'57'", "'15'")} AS TIMESTAMP) END AS cancel_driver_time,
       CASE WHEN k.id % 11 = 0 THEN CAST({_ts_text("'56'", "'45'")} || '.25' AS TIMESTAMP) END AS cancel_operator_time,
       CASE WHEN k.id % 13 = 0 THEN '2018-12-31' ELSE k.date_local END AS partition_date,
       CASE WHEN k.id % 10 = 9 THEN 'false' ELSE 'true' END AS winner,
       CAST(k.custkey % 6 AS STRING) AS vehicle_type_id
FROM bk_keys k
WHERE k.id % 3 <> 1
"""

MART_SOURCES = [name for name in STANDIN_SQL if name != "bk_keys"]

# Sources stored in folders by a string column, like the source tables' date
# partitions: ``year = '2018'`` and ``partition_date >= ...`` then prune folders.
PARTITIONED_BY = {
    "bookings": "year", "delivery_booking": "year", "delivery_info": "year", "express_event": "year", "booking_service": "year",
    "receipts": "year", "unique_bookings": "year", "candidate_metadata": "partition_date",
}

# Sources that the cube joins by the booking code are stored clustered by it, as large stored tables joined by one key are.
CLUSTERED_BY_CODE = {"receipts": "booking_code", "promo_bookings": "code", "incentive_payouts": "booking_code", "test_bookings": "code"}

# A bucket for each so many bytes of the provided tables (eight at least).
BUCKET_BYTES = 256 * 1024 * 1024

# Parameter values for the stand-in data (the mart itself takes them as arguments).
STANDIN_FAMILY = "Courier"


def standin_ctes(names=None) -> str:
    """``WITH`` clause defining the stand-ins (for the DuckDB oracle)."""
    names = list(STANDIN_SQL) if names is None else names
    parts = [f"{name} AS ({STANDIN_SQL[name].strip()})" for name in STANDIN_SQL if name in names]
    return "WITH " + ",\n".join(parts)


# The provided tables that the derivations read.
BASE_TABLES = ("orders", "customer", "nation", "lineitem", "events", "supplier")


def _escaped(sql: str, frames) -> str:
    """``sql`` with the braces of its JSON texts doubled, those around the names of ``frames`` kept."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in frames:
        sql = sql.replace(f"{{{{{name}}}}}", f"{{{name}}}")
    return sql


class StandinTables(Mapping):
    """The mart's sources over one folder of provided tables, each derived when first asked for.

    A derived table is written once under the shared folder and read as a scan,
    like the stored source tables that the mart reads in production, with real
    sizes for the planner.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/parcelmart-standins-{uuid.uuid4().hex[:12]}"
        self.made: dict[str, DataFrame] = {}
        size = sum(n for _, n, _ in listing(spark, sf_dir, BASE_TABLES))
        #: Buckets of the tables joined by the booking code: of these, and of the steps made from them.
        self.buckets = min(max(8, -(-size // BUCKET_BYTES)), 100_000)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STANDIN_SQL:
            raise KeyError(name)
        if name not in self.made:
            sql = STANDIN_SQL[name]
            frames = {}
            for other in (*BASE_TABLES, "bk_keys"):
                if other != name and re.search(rf"\b(?:FROM|JOIN) {other}\b", sql):
                    # Frames are passed by name, so that no view of the caller's session is replaced.
                    frames[other] = self["bk_keys"] if other == "bk_keys" else load(self.spark, self.sf_dir, other)
                    sql = re.sub(rf"\b(FROM|JOIN) {other}\b", rf"\1 {{{other}}}", sql)
            made = self.spark.sql(_escaped(sql, frames), **frames)
            partition_by = [PARTITIONED_BY[name]] if name in PARTITIONED_BY else None
            if partition_by == ["partition_date"]:
                made = made.repartition("partition_date")  # a file a day, instead of one from every task
            path = f"{self.base}/{name}"
            if name in CLUSTERED_BY_CODE:
                self.made[name] = write_clustered(made, path, CLUSTERED_BY_CODE[name], self.buckets, partition_by)
            else:
                self.made[name] = write_table(made, path, partition_by)
            delete_at_end(self.spark, self.base)
        return self.made[name]

    def __iter__(self):
        return iter(MART_SOURCES)

    def __len__(self) -> int:
        return len(MART_SOURCES)


_LATEST: dict[tuple[str, str], tuple[tuple, StandinTables]] = {}


def standin_tables(spark: SparkSession, sf_dir: str) -> StandinTables:
    """The stand-in sources; made anew when a file of the provided tables has come, gone or changed."""
    key, now = (spark.sparkContext.applicationId, sf_dir), listing(spark, sf_dir, BASE_TABLES)
    known = _LATEST.get(key)
    if known is None or known[0] != now:
        known = _LATEST[key] = (now, StandinTables(spark, sf_dir))
    return known[1]
