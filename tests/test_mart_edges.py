"""Mart steps on tiny hand-built tables holding the edge rows of FIXTURES.md §3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelmart.plans import mart
from parcelmart.plans.mart import MartParams

P = MartParams(type_family="Courier")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def fares_tables(spark):
    info = frame(spark, [
        ("D1", '{"amount": 12}', "{}", "2018", "1", "5"),       # unpadded month parses
        ("D1", '{"amount": 13}', "{}", "2018", "01", "06"),     # second quote: second row
        ("D2", '{"amount": null}', "{}", "2018", "02", "01"),   # JSON null -> booking fare
        ("D3", '{"other": 1}', "{}", "2018", "02", "01"),       # no key -> booking fare
        ("D4", '{"amount": 7', "{}", "2018", "02", "01"),       # malformed -> booking fare
        ("D5", '{"amount": "abc"}', "{}", "2018", "02", "01"),  # not a number, NULL fare -> 0
        ("D6", '{"amount": 9}', "{}", "2017", "12", "31"),      # other year: dropped
        ("", '{"amount": 9}', "{}", "2018", "02", "01"),        # blank delivery code: dropped
    ], "delivery_code string, quote string, metadata string, year string, month string, day string")
    db = frame(spark, [
        ("PARTNER-1", "D1", "2018"), ("PARTNER-2", "D2", "2018"), ("PARTNER-3", "D3", "2018"),
        ("PARTNER-4", "D4", "2018"), ("PARTNER-5", "D5", "2018"), ("PARTNER-6", "D6", "2018"),
        ("APP-7", "", "2018"),
    ], "booking_code string, delivery_code string, year string")
    bookings = frame(spark, [
        ("PARTNER-1", 100.0, "2018", "t"), ("PARTNER-2", 200.0, "2018", "t"), ("PARTNER-3", 300.0, "2018", "t"),
        ("PARTNER-4", 400.0, "2018", "t"), ("PARTNER-5", None, "2018", "t"), ("PARTNER-6", 600.0, "2018", "t"),
    ], "code string, fare double, year string, is_unique_booking string")
    return {"delivery_info": info, "delivery_booking": db, "bookings": bookings}


def test_pax_fares_edges(spark, fares_tables):
    got = sorted(map(tuple, mart.pax_fares(fares_tables, P).collect()))
    assert got == [("PARTNER-1", 12.0), ("PARTNER-1", 13.0), ("PARTNER-2", 200.0), ("PARTNER-3", 300.0),
                   ("PARTNER-4", 400.0), ("PARTNER-5", 0.0)]


def test_booking_invoice_edges(spark):
    db = frame(spark, [
        ("B1", "D1", "2018", '{"merchantOrderID": "INV-1"}'),
        ("B2", "D2", "2018", '{"merchantOrderID": ""}'),  # empty invoice: dropped
        ("B3", "D3", "2018", "{}"),                      # no invoice anywhere: dropped
        (None, "D4", "2018", '{"merchantOrderID": "INV-4"}'),  # no booking: dropped
    ], "booking_code string, delivery_code string, year string, metadata string")
    ev = frame(spark, [("D1", "B1", "2018")], "orderid string, bookingcode string, year string")
    info = frame(spark, [("D1", '{"invoiceNo": "INV-1"}', "2018")], "delivery_code string, metadata string, year string")
    rel = frame(spark, [("D1", "INV-1"), ("D3", None)], "order_id string, merchant_order_id string")
    t = {"delivery_booking": db, "express_event": ev, "delivery_info": info, "order_merchant_order_relations": rel}
    # The same invoice from three sources and two pair sources is one row.
    assert [tuple(r) for r in mart.booking_invoice(t, P).collect()] == [("B1", "D1", "INV-1")]


def test_service_type_codes_and_max(spark):
    types = frame(spark, [(0,)], "taxi_type_id int")
    bs = frame(spark, [("B1", '{"expressMeta": {"jobCard": {"jobType": 2}}}', 0, "2018", "02", "01"),
                       ("B4", '{"expressMeta": {"jobCard": {"jobType": 1.5}}}', 0, "2018", "02", "01")],
               "booking_code string, metadata string, vehicle_type_id int, year string, month string, day string")
    db = frame(spark, [("B2", 1, "2018")], "booking_code string, service_type int, year string")
    ev = frame(spark, [("B1", "INSTANT"), ("B2", "SAME_DAY"), ("B3", "OTHER"), ("B4", None)],
               "bookingcode string, servicetype string")
    got = dict(map(tuple, mart.service_type_map({"booking_service": bs, "delivery_booking": db,
                                                 "express_event": ev}, P, types).collect()))
    # B1: max(2 from metadata, 0 INSTANT); B2: SAME_DAY=1; B3: other=-1; B4: 1.5 is no integer, NULL label=-1
    assert got == {"B1": 2, "B2": 1, "B3": -1, "B4": -1}


def test_merchant_mapping_fallback(spark):
    bookings = frame(spark, [("PARTNER-00000007-1", 0, "2018", "2018-03-01"), ("PARTNER9", 0, "2018", "2018-03-01"),
                             ("PARTNER-00000008-2", 0, "2018", "2018-02-01")],  # not after the bound: dropped
                     "code string, taxi_type_id int, year string, partition_date string")
    types = frame(spark, [(0, "Courier")], "id int, taxi_type_simple string")
    db = frame(spark, [("PARTNER9", None)], "booking_code string, user_id long")
    got = sorted(map(tuple, mart.merchant_mapping({"bookings": bookings, "taxi_types": types,
                                                   "delivery_booking": db}, P).collect()))
    assert got == [("PARTNER-00000007-1", "00000007"), ("PARTNER9", None)]


def test_month_rate_join_fans_out_and_misses(spark):
    bk = frame(spark, [(1, 4, "2018-06-10"), (2, 5, "2018-07-10")], "id int, country_id int, date_local string")
    rates = frame(spark, [(4, dt.date(2018, 6, 15), 2.0), (4, dt.date(2018, 6, 28), 4.0), (5, dt.date(2018, 6, 28), 8.0)],
                  "country_id int, end_date date, exchange_one_usd double")
    got = sorted(map(tuple, mart.with_month_rate(bk, rates, "country_id", F.to_date("date_local"))
                     .select("id", "exchange_one_usd").collect()), key=str)
    assert got == [(1, 2.0), (1, 4.0), (2, None)]


def test_cube_measures_on_edge_rows(spark):
    rows = frame(spark, [
        # awarded with passenger and driver cancel times: passenger wins; zero rate -> USD 0
        ("PARTNER-1", "t", "CANCELLED_PASSENGER", 100.0, None, 0.0,
         dt.datetime(2018, 2, 1, 10, 0, 0), dt.datetime(2018, 2, 1, 10, 5, 0), dt.datetime(2018, 2, 1, 10, 1, 0),
         None, "2018-02-01 09:59:00", "t", 1),
        # not awarded: both time measures 0; NULL state counts in neither ALLOC nor UNALLOC
        ("APP-2", "f", None, None, 5.0, 2.0, None, None, None, None, None, "f", 2),
    ], """code string, is_unique_booking string, state string, fare double, pax_Fare double, exchange_one_usd double,
          awarded_time timestamp, cancel_passenger_time timestamp, cancel_driver_time timestamp,
          cancel_operator_time timestamp, first_at string, first_allocated string, _w int""")
    for c, typ in [("promo", "boolean"), ("distance", "double"), ("commission", "double"),
                   ("tolls_and_surcharges", "double"), ("booking_fee", "double"), ("promo_expense_local", "double"),
                   ("incentive_payout", "double"), ("merchant_name", "string"), ("area", "string"),
                   ("service_type", "int")]:
        rows = rows.withColumn(c, F.lit(None).cast(typ))
    rows = rows.withColumn("hour_local", F.lit("10")).withColumn("country_name", F.lit("C")) \
        .withColumn("city_name", F.lit("X")).withColumn("date_local", F.lit("2018-02-01"))
    cube = mart.cube_from_rows(rows, weight=F.col("_w")).collect()
    by_code = {r.api_flag: r for r in cube}
    partner, app = by_code[1], by_code[0]
    assert partner.time_to_cancellation == 300 and partner.time_to_allocation == 60
    assert partner.dax_fare_all_bookings_USD == 0.0 and partner.pax_fare_all_bookings == 100.0
    assert partner.cancelled_fare == 100.0 and partner.completed_fare is None
    assert app.all_bookings == 2 and app.allocated_nonUB == 0 and app.unallocated_nonUB == 0
    assert app.time_to_allocation == 0 and app.time_to_cancellation == 0
    assert partner.service_type == "unmapped" and app.service_type == "APP"
    assert partner.merchant_name == "Unknown" and partner.pickup_area == "Other Areas"


def test_pax_fares_end_date(spark, fares_tables):
    from dataclasses import replace

    got = sorted(map(tuple, mart.pax_fares(fares_tables, replace(P, end_date="2018-01-31")).collect()))
    assert got == [("PARTNER-1", 12.0), ("PARTNER-1", 13.0)]
