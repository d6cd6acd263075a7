"""The 64 measures of the daily booking-metrics cube, as data.

Each entry is ``(output name, predicate key, measure key, else)``:
``else`` is ``"0"`` for ``SUM(CASE WHEN p THEN m ELSE 0 END)`` and ``"null"``
for ``ELSE NULL`` (a group with no hit sums to NULL). Predicate ``None``
sums every row. The keys are resolved against the per-row flag and measure
columns built in ``parcelmart.plans.mart``; a NULL flag counts as a miss.

Predicate keys (fixed values of the source metric definitions):

    UB       is_unique_booking = 't'
    FA       first_allocated = 't'
    PROMO    a promo row joined (promo = TRUE)
    RIDE     state in ADVANCE_AWARDED, AWARDED, COMPLETED, DROPPING_OFF, PICKING_UP
    CXL      state in CANCELLED_PASSENGER, CANCELLED_OPERATOR, CANCELLED_DRIVER
    CXL_PAX / CXL_OPS / CXL_DAX   the single cancelled state
    ALLOC    state NOT IN ('UNALLOCATED');  UNALLOC  state = 'UNALLOCATED'
    AWARDED  awarded_time IS NOT NULL
"""

from __future__ import annotations

# Booking states that count as rides and as cancellations.
RIDE_STATES = ("ADVANCE_AWARDED", "AWARDED", "COMPLETED", "DROPPING_OFF", "PICKING_UP")
CANCELLED_STATES = ("CANCELLED_PASSENGER", "CANCELLED_OPERATOR", "CANCELLED_DRIVER")
UNALLOCATED_STATE = "UNALLOCATED"

# The metric definitions, in output order.
METRICS: list[tuple[str, tuple[str, ...] | None, str, str]] = [
    ("unique_bookings", ("UB",), "ONE", "0"),
    ("promo_unique_bookings", ("UB", "PROMO"), "ONE", "0"),
    ("first_allocated_bookings", ("FA",), "ONE", "0"),
    ("first_allocated_UB", ("FA", "UB"), "ONE", "0"),
    ("allocated_nonUB", ("ALLOC",), "ONE", "0"),
    ("allocated_UB", ("ALLOC", "UB"), "ONE", "0"),
    ("unallocated_nonUB", ("UNALLOC",), "ONE", "0"),
    ("unallocated_UB", ("UNALLOC", "UB"), "ONE", "0"),
    ("non_ub_cancelled", ("CXL",), "ONE", "0"),
    ("ub_cancelled", ("UB", "CXL"), "ONE", "0"),
    ("non_ub_pax_cancelled", ("CXL_PAX",), "ONE", "0"),
    ("ub_pax_cancelled", ("UB", "CXL_PAX"), "ONE", "0"),
    ("non_ub_opr_cancelled", ("CXL_OPS",), "ONE", "0"),
    ("ub_opr_cancelled", ("UB", "CXL_OPS"), "ONE", "0"),
    ("non_ub_driver_cancelled", ("CXL_DAX",), "ONE", "0"),
    ("ub_driver_cancelled", ("UB", "CXL_DAX"), "ONE", "0"),
    ("first_allocated_rides", ("FA", "RIDE"), "ONE", "0"),
    ("rides", ("RIDE",), "ONE", "0"),
    ("promo_rides", ("RIDE", "PROMO"), "ONE", "0"),
    ("dax_fare_all_bookings", ("UB",), "FARE0", "0"),
    ("dax_fare_rides", ("UB", "RIDE"), "FARE0", "0"),
    ("pax_fare_rides", ("UB", "RIDE"), "PAX_FARE", "0"),
    ("pax_fare_all_bookings", ("UB",), "PAX_FARE", "0"),
    ("dax_fare_all_bookings_USD", ("UB",), "FARE_USD0", "0"),
    ("dax_fare_rides_USD", ("UB", "RIDE"), "FARE_USD0", "0"),
    ("pax_fare_rides_USD", ("UB", "RIDE"), "PAX_FARE_USD0", "0"),
    ("pax_fare_all_bookings_USD", ("UB",), "PAX_FARE_USD0", "0"),
    ("distance_unique_bookings", ("UB",), "DIST0", "0"),
    ("distance_promo_unique_bookings", ("UB", "PROMO"), "DIST0", "0"),
    ("distance_rides", ("RIDE",), "DIST0", "0"),
    ("distance_promo_rides", ("RIDE", "PROMO"), "DIST0", "0"),
    ("all_bookings", None, "ONE", "0"),
    ("GMV_unique_bookings", ("UB",), "GMV", "0"),
    ("GMV_promo_unique_bookings", ("UB", "PROMO"), "GMV", "0"),
    ("job_cancelled_by_dax", ("CXL_DAX",), "ONE", "0"),
    ("job_cancelled_by_pax", ("CXL_PAX",), "ONE", "0"),
    ("job_cancelled_by_ops", ("CXL_OPS",), "ONE", "0"),
    ("booking_cancelled_by_dax", ("CXL_DAX", "UB"), "ONE", "0"),
    ("booking_cancelled_by_pax", ("CXL_PAX", "UB"), "ONE", "0"),
    ("booking_cancelled_by_ops", ("CXL_OPS", "UB"), "ONE", "0"),
    ("time_to_allocation", ("AWARDED",), "SECS_TO_AWARD", "0"),
    ("time_to_cancellation", None, "SECS_TO_CANCEL", "0"),
    ("commission_rides", ("RIDE",), "COMMISSION0", "0"),
    ("promo_expense_rides", ("RIDE",), "PROMO_EXPENSE0", "0"),
    ("incentive_payout_rides", ("RIDE",), "INCENTIVE0", "0"),
    ("fare_rides", ("RIDE",), "FARE0", "0"),
    ("fare_promo_rides", ("RIDE", "PROMO"), "FARE0", "0"),
    ("fare_unique_bookings", ("UB",), "FARE0", "0"),
    ("fare_promo_unique_bookings", ("UB", "PROMO"), "FARE0", "0"),
    ("GMV_rides", ("RIDE",), "GMV", "0"),
    ("GMV_promo_rides", ("RIDE", "PROMO"), "GMV", "0"),
    ("commission_rides_USD", ("RIDE",), "COMMISSION_USD0", "0"),
    ("promo_expense_rides_USD", ("RIDE",), "PROMO_EXPENSE_USD0", "0"),
    ("incentive_payout_rides_USD", ("RIDE",), "INCENTIVE_USD0", "0"),
    ("fare_rides_USD", ("RIDE",), "FARE_USD0", "0"),
    ("fare_promo_rides_USD", ("RIDE", "PROMO"), "FARE_USD0", "0"),
    ("fare_unique_bookings_USD", ("UB",), "FARE_USD0", "0"),
    ("fare_promo_unique_bookings_USD", ("UB", "PROMO"), "FARE_USD0", "0"),
    ("GMV_rides_USD", ("RIDE",), "GMV_USD", "0"),
    ("GMV_promo_rides_USD", ("RIDE", "PROMO"), "GMV_USD", "0"),
    ("completed_distance", ("RIDE", "UB"), "DIST", "null"),
    ("completed_fare", ("RIDE", "UB"), "FARE", "null"),
    ("cancelled_distance", ("CXL", "UB"), "DIST", "null"),
    ("cancelled_fare", ("CXL", "UB"), "FARE", "null"),
]

# Measures that are counts (BIGINT); all others are DOUBLE sums.
COUNT_MEASURES = {"ONE", "SECS_TO_AWARD", "SECS_TO_CANCEL"}

assert len(METRICS) == 64
