"""DataFrame operators the mart is built from.

Every operator is ``DataFrame -> DataFrame`` and builds a logical plan only;
nothing is collected to the driver.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.functions.scalar import floor_bucket


def _upper(width) -> Column:
    """The bucket's upper edge, written with as many decimals as the width."""
    exact = Decimal(str(width))
    if exact == exact.to_integral_value():
        return F.col("bucket_floor") + F.lit(width)
    return (F.col("bucket_floor") + F.lit(exact)).cast(f"decimal(28,{-exact.as_tuple().exponent})")


def bucketize(df: DataFrame, value: str, width=5, sort: bool = True) -> DataFrame:
    """B1: fixed-width histogram ``bucket_floor, bucket_name, count``.

    Buckets are half-open ``[floor, floor + width)``; empty buckets are absent;
    a NULL value forms one NULL bucket. The plan is a partial aggregate, one
    shuffle on the bucket, and a range-partitioned sort of the (small) result.
    """
    out = (
        df.select(floor_bucket(value, width).alias("bucket_floor"))
        .groupBy("bucket_floor")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bucket_floor",
            F.concat(
                F.col("bucket_floor").cast("string"), F.lit(" to "), _upper(width).cast("string")
            ).alias("bucket_name"),
            "count",
        )
    )
    return out.orderBy(F.asc_nulls_last("bucket_floor")) if sort else out


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of branches renamed to one schema, then DISTINCT.

    One final distinct is enough: its map-side part removes duplicates inside
    each branch's tasks before the shuffle.
    """
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def max_per_key(frames: list[DataFrame], key: str, value: str) -> DataFrame:
    """U3 + A10: UNION ALL of branches, then the largest ``value`` per ``key``."""
    return reduce(lambda a, b: a.unionByName(b), frames).groupBy(key).agg(F.max(value).alias(value))


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (LEFT JOIN ... WHERE key IS NULL).

    Written as a left anti join so Spark plans an anti join instead of an outer
    join plus filter. NULL keys never match, so those rows are kept, as in the idiom.
    """
    return df.join(other, on, "left_anti")


def mark_hits(df: DataFrame, flag: str = "hit") -> DataFrame:
    """Constant TRUE column; after a left join it is TRUE on a hit, NULL on a miss."""
    return df.withColumn(flag, F.lit(True))


def top1_per_group(
    df: DataFrame,
    key: str | list[str],
    order: list[Column],
    descending: bool,
    columns: list[str] | None = None,
) -> DataFrame:
    """W1/W2 + F14 + O2: the first or last row per ``key`` by ``order``, NULL ordering values last.

    ``ROW_NUMBER() = 1`` over ``order`` and then the row's other columns, so the
    order is total and a recomputed partition picks the same row. Spark keeps
    one row per key of each map task before the shuffle (a partial group
    limit), so a hot key (for instance the NULL group that collects every
    unmapped row) reaches its partition as one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = columns or [c for c in df.columns if c not in keys]
    rest = [F.desc_nulls_last(c) if descending else F.asc_nulls_first(c) for c in columns]
    first = [o.desc_nulls_last() if descending else o.asc_nulls_last() for o in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*first, *rest)))
    return ranked.where(F.col("_rank") == 1).select(*keys, *columns)


def conditional_sum(pred: Column | None, measure: Column, otherwise_zero: bool = True) -> Column:
    """``SUM(CASE WHEN pred THEN measure ELSE 0 END)``.

    With ``otherwise_zero=False`` the ELSE is NULL, so a group with no hit sums to NULL.
    ``pred=None`` sums every row. A NULL predicate counts as a miss.
    """
    if pred is None:
        return F.sum(measure)
    when = F.when(pred, measure)
    return F.sum(when.otherwise(F.lit(0)) if otherwise_zero else when)


def spread_null_key(key: Column, salt: Column) -> Column:
    """Join key for the preserved side of a chain of left/anti joins on a text key.

    The key itself, or for a NULL one a text that no key holds (it starts with
    a NUL character), spread by ``salt``: such rows still match nothing, but
    they do not hash to one shuffle partition -- a hot NULL group that AQE's
    skew split cannot reach once the joins are chained on one partitioning. The
    other side joins with its plain key, so Spark drops its NULL keys at the scan.
    """
    return F.coalesce(key, F.concat(F.lit("\0"), salt.cast("string")))


def weighted_distinct(df: DataFrame, key: str, weight: str) -> DataFrame:
    """Distinct rows of ``df`` with their multiplicity in ``weight``; rows with a NULL ``key`` go.

    For a left join on ``key``, identical right rows give identical joined rows,
    so a right side can be replaced by its distinct rows and the count folded
    into a weight of the result. Counts are combined map-side.
    """
    return df.where(F.col(key).isNotNull()).groupBy(*df.columns).agg(F.count(F.lit(1)).alias(weight))
