"""Array helpers re-aimed from list snippets.

Python lists become ``ArrayType`` columns; indices follow Python (0-based,
negative from the end) and are translated to Spark's 1-based ``element_at``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def index_of(arr, value, strict: bool = False) -> Column:
    """``list.index(value)`` -> 0-based position of the first match.

    Absent value: NULL, or with ``strict`` a task error like Python's ValueError.
    """
    pos = F.array_position(_col(arr), value if isinstance(value, Column) else F.lit(value))
    missing = F.raise_error(F.lit("value is not in list")) if strict else F.lit(None)
    return F.when(pos > 0, pos - 1).otherwise(missing)


def any_multiple(arr, k: int = 7) -> Column:
    """``any(x % k == 0 for x in arr)``; empty array is false, NULL elements give NULL."""
    return F.exists(_col(arr), lambda x: x % F.lit(k) == 0)


def any_multiple_agg(value, k: int = 7) -> Column:
    """Y8, grouped: the same test over the values of a group (no array is built)."""
    return F.bool_or(_col(value) % F.lit(k) == 0)


def min_as_int(*strings) -> Column:
    """``min(s1, s2, ..., key=int)``: the string whose integer value is smallest.

    Ties go to the earliest argument. A value that does not parse as an
    integer makes the result NULL (Python raises).
    """
    cols = [_col(s) for s in strings]
    keys = [c.try_cast("bigint") for c in cols]
    entries = [F.struct(k.alias("k"), F.lit(i).alias("i"), c.alias("s")) for i, (k, c) in enumerate(zip(keys, cols))]
    any_bad = None
    for k in keys:
        any_bad = k.isNull() if any_bad is None else (any_bad | k.isNull())
    return F.when(~any_bad, F.array_min(F.array(*entries))["s"])


def _pos(i: int) -> int:
    return i + 1 if i >= 0 else i


def at(arr, *indices: int, strict: bool = False) -> Column:
    """``x[i][j]...`` with Python indices; out of range gives NULL unless ``strict``."""
    out = _col(arr)
    for i in indices:
        out = F.element_at(out, _pos(i)) if strict else F.try_element_at(out, F.lit(_pos(i)))
    return out


def rows_of(arr, width: int) -> Column:
    """Reshape a flat array into rows of ``width`` (a 2-D array, row-major)."""
    a = _col(arr)
    n_rows = F.floor(F.size(a) / F.lit(width)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n_rows - 1),
        lambda r: F.slice(a, r * F.lit(width) + 1, F.lit(width)),
    )


def to_double_array(arr) -> Column:
    """``numpy.asarray(list)`` -> ``array<double>``."""
    return _col(arr).cast("array<double>")


def add_scalar(arr, value) -> Column:
    """``array + value`` adds to every element (NumPy broadcasting)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.transform(_col(arr), lambda x: x + v)
