"""Operator 12, the prefix trie of conversations by collapse of whole sequences.

Turns are narrowed to a digest and a length at the scan; no text is shuffled.
A prefix is named by the exclusive-or of 128-bit hashes of its turns with their
places, a running value, so that a conversation of any length streams through
its window. Then

1. identical conversations are one weighted sequence: its weight, its smallest
   member, and the ascending list of those that end there;
2. sequences that are a proper prefix of another go by anti-join; what is left
   are the leaves of the trie;
3. one aggregation over the prefixes of the weighted sequences gives members,
   leaves and, for each node, the leaf that owns it (the smallest below it).

The nodes that a leaf owns are the end of its path, so sums over subtrees are
sums over the ends of paths: one row for each turn of a distinct sequence,
however deep the trie. A node that very many sequences pass through (the root, a
common first turn) is combined map-side, and its rows meet its totals by a
broadcast of such nodes only, at most ``HOT`` of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.common import stored

#: A node that more than this share of all rows pass through is met by broadcast; so there are at most 1/share.
HOT = 1000
#: Ids in a piece of an end list.
PIECE = 10_000

EMPTY = hashlib.sha256(b"").hexdigest()


def grafted_turns(conversations: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: ``(conv_id)`` of all, and their turns ``conv_id, pos, high, low, chars``.

    Conversation ``c`` is the first ``h`` turns of ``c - c % every``, then its
    own turns after its first ``h``; ``h`` is the unsigned crc32 of the decimal
    id modulo ``most``. Turns are ordered by ``turn`` (null first);
    those of one number by the SHA-256 of their role and text, so that equal ones are side by side.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps role and text apart.
    digest = F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.unhex(digest).alias("digest"), F.length(text).cast("bigint").alias("chars")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    turns = stored(turns.select("conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "digest", "chars"), "turns")
    convs = turns.select("conv_id").distinct().select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    )
    first = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    trunks = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("trunk"))
    convs = convs.join(trunks, "base", "left").select("conv_id", "h", F.slice("trunk", F.lit(1), F.col("h")).alias("trunk"))
    convs = stored(convs, "rebuilt")
    heads = convs.select("conv_id", F.explode("trunk").alias("t")).select("conv_id", "t.pos", "t.digest", "t.chars")
    shift = convs.select("conv_id", "h", F.when(F.col("trunk").isNull(), 0).otherwise(F.size("trunk")).alias("n_trunk"))
    tails = turns.join(shift, "conv_id").where(F.col("pos") > F.col("h"))
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("n_trunk")).alias("pos"), "digest", "chars")
    half = {name: F.xxhash64(F.lit(seed), F.col("pos"), F.col("digest")).alias(name) for name, seed in (("high", 1), ("low", 2))}
    return convs.select("conv_id"), heads.unionByName(tails).select("conv_id", "pos", half["high"], half["low"], "chars")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the name of the prefix that it ends: ``conv_id, pos, high, low, chars``."""
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.select("conv_id", "pos", F.bit_xor("high").over(so_far).alias("high"), F.bit_xor("low").over(so_far).alias("low"), "chars")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``high, low, depth, conv_id`` in order, to pieces of the comma-joined list of each node, in order."""
    key, ids = None, []

    def written(pieces: list) -> pa.RecordBatch:
        names = ("high", "low", "depth", "first", "piece")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pieces], k) for i, k in enumerate(kinds)], list(names))

    for batch in batches:
        out = []
        for high, low, depth, conv_id in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "depth", "conv_id"))):
            if key != (high, low, depth) or len(ids) == PIECE:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = (high, low, depth), []
            ids.append(conv_id)
        yield written(out)
    if ids:
        yield written([(*key, ids[0], ",".join(map(str, ids)))])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, to one SHA-256 a node; a piece is in memory at a time."""
    key, digest = None, None

    def written(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["high", "low", "depth", "ends_sha256"])

    for batch in batches:
        out = []
        for high, low, depth, piece in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "depth", "piece"))):
            if key != (high, low, depth):
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (high, low, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield written(out)
    if key:
        yield written([(*key, digest.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """``high, low, depth, ends_sha256`` from the sequence of each conversation.

    Ids are sorted over all tasks by node and id, so a node with very many of
    them is joined by many tasks in pieces, and only the pieces meet.
    """
    ends = ends.select("high", "low", "depth", "conv_id")
    order = ["high", "low", "depth", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(_joined_ids, "high bigint, low bigint, depth bigint, first bigint, piece string")
    pieces = pieces.repartition("high", "low", "depth").sortWithinPartitions("high", "low", "depth", "first")
    return pieces.mapInArrow(_digests, "high bigint, low bigint, depth bigint, ends_sha256 string")


def _meet(rows: DataFrame, totals: DataFrame, n_rows: int, key: list[str]) -> DataFrame:
    """``rows`` with the ``totals`` of their node (column ``passed``: its rows), all matched.

    Nodes passed by more than one in ``HOT`` of the ``n_rows`` rows are at most ``HOT``: they are broadcast, so
    their rows are not shuffled to one task. The others meet by a shuffle.
    """
    hot = totals.where(F.col("passed") * HOT > n_rows)
    named = F.broadcast(hot.select(*key, F.lit(True).alias("is_hot")))
    split = rows.join(named, key, "left")
    warm = split.where("is_hot").drop("is_hot").join(F.broadcast(hot), key)
    cool = split.where("is_hot IS NULL").drop("is_hot").join(totals.where(F.col("passed") * HOT <= n_rows), key)
    return warm.unionByName(cool)


def prefix_trie(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (``grafted_turns``), one row each.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Edge cases: a null turn comes first; a null role or text is empty; turns of
    one number (repeated rows among them) all count, in the order of their digests.
    Rows with a null ``conv_id`` belong to no conversation and are left out. A
    conversation may be rebuilt without turns: it ends at the root. No rows
    give no nodes. Extra columns are not read.
    """
    key = ["high", "low", "depth"]
    convs, turns = grafted_turns(conversations, every, most)
    paths = stored(prefixes(turns).withColumnRenamed("pos", "depth"), "paths")
    last = paths.groupBy("conv_id").agg(F.max_by(F.struct("high", "low"), "depth").alias("s"), F.max("depth").alias("depth"))
    zero = F.lit(0).cast("bigint")
    ends = convs.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("s.high", zero).alias("high"), F.coalesce("s.low", zero).alias("low"), F.coalesce("depth", zero).alias("depth")
    )
    ends = stored(ends, "ends")

    # 1. Whole sequences, named by their last prefix.
    sequences = stored(ends.groupBy(*key).agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("weight")), "sequences")
    # 2. Their rows: the root, then a row for each prefix; proper prefixes take sequences out of the leaves.
    chosen = sequences.select(F.col("first").alias("conv_id"), "weight", F.col("depth").alias("length"))
    rows = paths.join(chosen, "conv_id").select(*key, "chars", F.col("conv_id").alias("first"), "weight", "length")
    root = chosen.select(zero.alias("high"), zero.alias("low"), zero.alias("depth"), zero.alias("chars"), F.col("conv_id").alias("first"), "weight", "length")
    rows = stored(rows.unionByName(root), "weighted")
    inner = rows.where("depth < length").select(*key).distinct()
    leaves = sequences.join(inner, key, "left_anti").select("first", F.lit(True).alias("leaf"))
    rows = stored(rows.join(leaves, "first", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))), "marked")

    # 3. Members, leaves and owner of each node.
    owner: Column = F.min(F.when(F.col("leaf"), F.col("first")))
    nodes = rows.groupBy(*key).agg(
        F.min("first").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count(F.when(F.col("leaf"), 1)).alias("n_leaves"),
        owner.alias("owner"), F.count(F.lit(1)).alias("passed"),
    )
    nodes = stored(nodes, "nodes")
    met = _meet(rows, nodes.select(*key, "conv_id", "owner", "passed"), rows.count(), key)
    path = Window.partitionBy("first").orderBy("depth")
    onward = Window.partitionBy("first").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = F.col("leaf") & (F.col("owner") == F.col("first"))
    walked = met.select(
        *key, F.lag("conv_id").over(path).alias("parent"), F.lead(owned.cast("int")).over(path).alias("owns_child"),
        (F.col("weight") * F.sum("chars").over(onward)).alias("all_chars"), F.sum(F.when(owned, F.col("chars")).otherwise(0)).over(onward).alias("own_chars"),
    )
    sums = walked.groupBy(*key).agg(
        F.max("parent").alias("parent_conv_id"), F.coalesce(F.sum("owns_child"), zero).alias("n_children"),
        (F.sum("all_chars") - F.sum("own_chars")).alias("saved_tokens"),
    )
    out = nodes.join(sums, key).join(end_digests(ends), key, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")
    )
