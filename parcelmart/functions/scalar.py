"""Column helpers for the mart's scalar expressions.

All helpers return native Spark expressions, so they stay inside whole-stage
codegen. Conventions:

* ANSI mode is on. Parsing helpers come in a strict form (error on bad input,
  like the source SQL without TRY) and a ``try_`` form (NULL on bad input).
* Divisions by a rate use ``try_divide``: a zero rate gives NULL instead of a
  DIVIDE_BY_ZERO failure of the whole job.
"""

from __future__ import annotations

import datetime as _dt
import re

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp text layout used by the source data
# ('%Y-%m-%d %H:%i:%s' in the source dialect) and the ISO pieces removed before parsing.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
ISO_REPLACEMENTS = (("T", " "), ("Z", ""), (".000", ""))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- strings -----------------------------------------------------------------

def has_prefix(c, prefix: str) -> Column:
    """``substr(c, 1, len(prefix)) = prefix``; NULL stays NULL.

    Written as ``startswith`` so it reaches the parquet reader as a pushed
    ``StringStartsWith`` filter (row groups whose min/max exclude the prefix are skipped).
    """
    return _col(c).startswith(prefix)


def not_blank(c) -> Column:
    """not NULL and not the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def split_part(c, sep: str, n: int) -> Column:
    """N-th (1-based) piece of ``c`` split on the literal ``sep``.

    NULL when the piece does not exist (the ANSI subscript would raise).
    """
    return F.get(F.split(_col(c), re.escape(sep)), n - 1)


def strip_digits(c) -> Column:
    """Remove every decimal digit."""
    return F.regexp_replace(_col(c), r"\d", "")


def replace_all(c, pairs) -> Column:
    """Chained literal REPLACE."""
    out = _col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


# --- dates and times ----------------------------------------------------------

def date_from_parts(year, month, day) -> Column:
    """F8: ``DATE(year || '-' || month || '-' || day)``; unpadded parts parse.

    Any NULL part gives NULL (``concat`` is NULL-strict).
    """
    return F.to_date(F.concat(_col(year), F.lit("-"), _col(month), F.lit("-"), _col(day)))


def parts_text(year, month, day) -> Column:
    """the same parts as text, compared as text (no padding added)."""
    return F.concat(_col(year), F.lit("-"), _col(month), F.lit("-"), _col(day))


def day_before(day: str) -> str:
    """``date_format(date_parse(day) - INTERVAL '1' DAY)`` on a constant."""
    return (_dt.date.fromisoformat(day) - _dt.timedelta(days=1)).isoformat()


def parse_ts(c, strict: bool = True) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` to timestamp (strict raises, else NULL)."""
    if strict:
        return F.to_timestamp(_col(c), TS_FORMAT)
    return F.try_to_timestamp(_col(c), F.lit(TS_FORMAT))


def parse_ts_dropping_millis(c, strict: bool = True) -> Column:
    """X6 + X14 (+X13 when not strict): drop a literal '.000', then parse."""
    return parse_ts(replace_all(c, [(".000", "")]), strict=strict)


def parse_iso_z(c) -> Column:
    """ISO text such as ``2018-03-01T10:00:00.000Z`` to timestamp, NULL on failure.

    Only zero milliseconds are removed; other fractions give NULL, as in the source.
    """
    return F.try_to_timestamp(replace_all(c, ISO_REPLACEMENTS), F.lit(TS_FORMAT))


def elapsed_seconds(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (``end - start``), truncated."""
    micros = [F.unix_micros(_col(c).cast("timestamp")) for c in (start, end)]
    # A difference of two integers; ``timestamp_diff`` makes two calendar objects for every row.
    return F.call_function("div", micros[1] - micros[0], F.lit(1_000_000).cast("bigint"))


def whole_minutes(start, end) -> Column:
    """X18 + X25: elapsed seconds integer-divided by 60, truncating toward zero."""
    secs = elapsed_seconds(start, end)
    return (secs / F.lit(60)).cast("bigint")


def week_start(d) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(_col(d), "week")


def month_start(d) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_col(d), "month")


def in_validity(t, start, end) -> Column:
    """half-open ``[start, end)``, open when ``start`` is NULL."""
    t, start, end = _col(t), _col(start), _col(end)
    return ((t >= start) & (t < end)) | start.isNull()


# --- JSON ---------------------------------------------------------------------

def json_text(c, path: str) -> Column:
    """Value at ``path`` as text; JSON null, missing key or bad JSON give NULL."""
    return F.get_json_object(_col(c), path)


def json_fields(c, keys: list[str]) -> Column:
    """X21 for several top-level keys at once: a struct of their values as text, from one parse of the text.

    As ``json_text``: JSON null, a missing key and bad JSON give NULL. Of a key written twice the last value counts.
    """
    return F.from_json(_col(c), ", ".join(f"`{k}` STRING" for k in keys))


def json_double(c, path: str) -> Column:
    """Value at ``path`` as DOUBLE, NULL when it is not a number."""
    return json_text(c, path).try_cast("double")


def json_int(c, path: str) -> Column:
    """Value at a (possibly nested) path as INT, NULL when not an integer."""
    return json_text(c, path).try_cast("int")


# --- numbers --------------------------------------------------------------------

def per_rate(amount, rate) -> Column:
    """``amount / rate``; NULL when the rate is NULL or zero."""
    return F.try_divide(_col(amount), _col(rate))


def floor_bucket(x, width) -> Column:
    """Lower edge of the width-``width`` bucket holding ``x`` (toward -inf).

    A fractional width counts in decimals, so the edges are its exact multiples.
    """
    exact = Decimal(str(width))
    if exact == exact.to_integral_value():
        return F.floor(_col(x) / F.lit(width)) * F.lit(width)
    places = -exact.as_tuple().exponent
    return (F.floor(_col(x).cast("decimal(28,10)") / F.lit(exact)) * F.lit(exact)).cast(f"decimal(28,{places})")


def minus_interval(ts, amount, unit: str) -> Column:
    """``ts - INTERVAL amount unit`` for columns; ``unit``: days, hours, mins or secs."""
    return _col(ts) - F.make_dt_interval(**{unit: _col(amount)})
