"""Operator 2, sharding by histogram sort; DataFrame operations only.

Documents are ordered by the key ``(hash of the text, hash of the id)``, so
equal texts lie side by side. Splitters cut the key order into shards of
near-equal bytes. They are found without sorting: in rounds, the exact bytes
below candidate boundaries are counted across all partitions and the probes are
refined inside the cells that still hold a target, until every splitter is
within tolerance. A cell that is one text (a group of copies, possibly a third
of all rows) is refined by the id's hash, so groups stay whole as far as the
tolerance allows and a larger group is divided exactly.

A round reads only the narrow key table and brings at most ``2**FIRST`` or
``n_shards * 2**STEP`` counts to the driver, however large the data. After the
last round, rows are exchanged once, to many cells of the key order a shard;
places in a shard are numbered within the cells, offset by the cells' counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.common import fresh, stored

#: Bits of the key that the first round probes, and that each later one adds.
FIRST, STEP = 14, 8
#: Bits of each half that make a cell of the exchange.
CELL, HOT_CELL = 12, 10
#: A text with at least this share of the rows is dealt out by the id's hash as well.
HOT_SHARE = 1 / 256

LOWEST, TOP = -(1 << 63), 1 << 63


@dataclass
class Probe:
    """Where one splitter's target lies: a cell of the key, and the bytes below it."""

    target: float
    below: int = 0
    text_key: int | None = None  # set when the cell is inside one text's group
    prefix: int = 0
    bits: int = 0
    splitter: tuple[int, int] | None = None


def text_key(text: str | Column = "text") -> Column:
    return F.xxhash64(F.lit("text"), text)


def id_key(doc_id: str | Column = "doc_id") -> Column:
    return F.xxhash64(F.lit("id"), doc_id)


def byte_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float) -> list[tuple[int, int]]:
    """``n_shards - 1`` ascending keys ``(k1, k2)``; a row belongs to as many shards onward as splitters are at or below its key."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / n_shards
    probes = [Probe(total * i / n_shards) for i in range(1, n_shards)]
    while open_probes := [p for p in probes if p.splitter is None]:
        for inside in (False, True):
            mine = [p for p in open_probes if (p.text_key is not None) == inside]
            if mine:
                _round(keys, inside, mine, allowed)
    # Equal targets (no bytes) or a row wider than a shard can cross neighbours: keep them ascending.
    out: list[tuple[int, int]] = []
    for p in probes:
        out.append(max(p.splitter, out[-1]) if out else p.splitter)
    return out


def _round(keys: DataFrame, inside: bool, probes: list[Probe], allowed: float) -> None:
    """One histogram over the probes' cells; each probe ends, or moves into a smaller cell.

    ``inside``: the probes' cells lie inside one text's group each, and the id's hash is refined.
    """
    bits = min(p.bits for p in probes)
    probes = [p for p in probes if p.bits == bits]
    finer = min(64, bits + (STEP if bits or inside else FIRST))
    key = "k2" if inside else "k1"
    group = F.col("k1") if inside else F.lit(None).cast("bigint")
    rows = keys
    if inside or bits:
        prefix = F.shiftright(key, 64 - bits) if bits else F.lit(0)
        wanted = F.lit(False)
        for text, at in sorted({(p.text_key or 0, p.prefix) for p in probes}):
            wanted = wanted | ((F.col("k1") == text) & (prefix == at) if inside else prefix == at)
        rows = rows.where(wanted)
    cells = (
        rows.groupBy(group.alias("text"), F.shiftright(key, 64 - finer).alias("cell"))
        .agg(F.sum("size").alias("bytes"), F.min("k1").alias("low"), F.max("k1").alias("high"),
             F.min("k2").alias("low2"), F.max("k2").alias("high2"))
        .orderBy("text", "cell")
        .collect()
    )
    for p in probes:
        at, step = p.below, finer - bits
        for c in cells:
            if c.text != p.text_key or bits and c.cell >> step != p.prefix:
                continue
            if at + c.bytes >= p.target:
                break
            at += c.bytes
        else:
            p.splitter = (TOP - 1, TOP - 1)  # no bytes at or above the target
            continue
        below, above = p.target - at, at + c.bytes - p.target
        nearest = (c.cell if below <= above else c.cell + 1) << (64 - finer)
        if c.low == c.high and c.low2 == c.high2:  # nothing left to divide
            p.splitter = (c.low, c.low2) if below <= above else _boundary(c.low2 + 1, c.low)
        elif min(below, above) <= allowed:
            p.splitter = _boundary(nearest, p.text_key)
        elif not inside and c.low == c.high:
            p.below, p.text_key, p.prefix, p.bits = at, c.low, 0, 0
        else:
            p.below, p.prefix, p.bits = at, c.cell, finer


def _boundary(value: int, hot: int | None) -> tuple[int, int]:
    """The key at which a cell starts; past the last cell of a half, the first key after it."""
    if hot is None:
        return (value, LOWEST) if value < TOP else (TOP - 1, TOP - 1)
    if value < TOP:
        return hot, value
    return (hot + 1, LOWEST) if hot + 1 < TOP else (TOP - 1, TOP - 1)


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, tolerance: float = 0.01, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` plus ``size``, ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard).

    Every splitter is within ``tolerance`` of a shard's mean bytes from its
    target, or at the nearest boundary between two documents.

    Edge cases: a null text has size 8 and null texts are one group; rows equal
    in text and id cannot be told apart by a boundary and stay together, as do
    null ids of one text; a document wider than a shard leaves neighbours
    empty. No rows give no rows. Extra columns pass through; input columns
    called ``size``, ``shard`` or ``slot`` are replaced.
    """
    docs = docs.drop("size", "shard", "slot")
    keyed = docs.select(byte_size(text).alias("size"), text_key(text).alias("k1"), id_key(doc_id).alias("k2"))
    keys = stored(keyed, "keys")
    splitters = find_splitters(keys, n_shards, tolerance)
    shard = F.lit(0)
    for a, b in splitters:
        shard = shard + ((F.col("k1") > a) | ((F.col("k1") == a) & (F.col("k2") >= b))).cast("int")
    rows = keys.count()
    hot = [r.k1 for r in keys.groupBy("k1").count().where(F.col("count") >= max(2, rows * HOT_SHARE)).collect()]  # 1 / HOT_SHARE at most
    salt = F.when(F.col("k1").isin(hot), F.shiftright("k2", 64 - HOT_CELL)).otherwise(0) if hot else F.lit(0).cast("bigint")
    cell = [shard.alias("shard"), F.shiftright("k1", 64 - CELL).alias("cell"), salt.alias("salt")]

    counts = keys.select(*cell).groupBy("shard", "cell", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell", "salt").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(counts.select("shard", "cell", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "places")

    row, place = fresh("row", docs), ["shard", "cell", "salt"]
    full = docs.select(F.struct(*docs.columns).alias(row), byte_size(text).alias("size"), text_key(text).alias("k1"), id_key(doc_id).alias("k2"))
    full = full.select(row, "size", "k1", "k2", *cell)
    rank = F.row_number().over(Window.partitionBy(*place).orderBy("k1", "k2"))
    numbered = full.withColumn("rank", rank).join(places, place)
    return numbered.select(f"{row}.*", "size", F.col("shard").cast("int").alias("shard"), (F.col("first") + F.col("rank") - 1).alias("slot"))
