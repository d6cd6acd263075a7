"""Joins in which a few keys hold a large share of the rows.

A shuffle join sends all rows of a key to one task. AQE splits such a partition
of a single join, but not once several joins share one partitioning, and not a
bucketed scan. So the keys above a share of the rows are found first, in one
counting pass that keeps a bounded sketch; their rows are joined apart, by a
salted key: the left rows are spread over ``SALTS`` values, the right rows
repeated for each. All other rows take the plain join. Which keys are set apart
changes no result, so an estimate is enough to find them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key above this share of the rows is hot: at most 1/HOT_SHARE keys are.
HOT_SHARE = 0.005
#: Values that the rows of a hot key are spread over.
SALTS = 64
#: Keys that the sketch of a task keeps; its estimates are exact to about rows / TRACKED.
TRACKED = 8_192


def hot_values(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The values of ``key`` that hold more than ``share`` of the rows of ``df``, at most ``1 / share`` of them.

    One pass with a mergeable frequent-items sketch; nothing is shuffled by the
    key. NULL is not a value: it joins nothing (see ``spread_null_key``).
    """
    wanted = int(1 / share) + 1
    row = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {wanted}, {max(TRACKED, 4 * wanted)})").alias("top")
    ).first()
    return sorted(item["item"] for item in row["top"] or [] if item["count"] > max(1, share * row["n"]))


def is_hot(key: Column, hot: list) -> Column:
    return F.coalesce(key.isin(hot), F.lit(False)) if hot else F.lit(False)


def salted_key(key: Column, row_id: Column, salts: int = SALTS) -> Column:
    """A text join key that spreads the rows of one key by their id."""
    return F.concat_ws("\0", key.cast("string"), F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("string"))


def salted_copies(df: DataFrame, key: str, name: str, salts: int = SALTS) -> DataFrame:
    """Every row once for each salt, its salted key in column ``name``: the other side of ``salted_key``."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    copies = df.withColumn("_salt", salt)
    return copies.withColumn(name, F.concat_ws("\0", F.col(key).cast("string"), F.col("_salt").cast("string"))).drop("_salt")


def hot_key_join(left: DataFrame, right: DataFrame, key: tuple[str, str], row_id: str, how: str = "left", hot: list | None = None, partitions: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``key`` (left, right column), the rows of hot keys by a salted key.

    ``how``: ``inner``, ``left``, ``left_semi`` or ``left_anti`` (the right rows are repeated, so the left side is the one kept).
    ``row_id``: a column that tells the left rows of one key apart. ``hot``: the hot keys, if known.
    ``partitions``: how many the rows of hot keys are dealt to. Few bytes may make very many joined rows, and AQE merges
    partitions by their bytes; it keeps a number that is named.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"hot_key_join keeps left rows: how={how!r} is not possible")
    hot = hot_values(left, key[0]) if hot is None else hot
    if not hot:
        return left.join(right, F.col(key[0]) == F.col(key[1]), how)
    # A condition on the key of either side reaches both scans: the cold join never reads hot rows.
    cold = left.where(~is_hot(F.col(key[0]), hot)).join(right.where(~is_hot(F.col(key[1]), hot)), F.col(key[0]) == F.col(key[1]), how)
    spread = left.where(is_hot(F.col(key[0]), hot)).withColumn("_left_salted", salted_key(F.col(key[0]), F.col(row_id)))
    copies = salted_copies(right.where(is_hot(F.col(key[1]), hot)), key[1], "_right_salted")
    if partitions:
        spread, copies = spread.repartition(partitions, "_left_salted"), copies.repartition(partitions, "_right_salted")
    warm = spread.join(copies, F.col("_left_salted") == F.col("_right_salted"), how)
    return cold.unionByName(warm.select(*cold.columns))
