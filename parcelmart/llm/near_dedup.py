"""Operator 7, near-duplicate documents by min-max hashing.

Every permutation is evaluated once per shingle and gives two signature values,
its minimum and its maximum, so half the hash evaluations fill a signature of
a given length, and the two estimate the same Jaccard similarity. Bands of the
signature bring candidates together; a link counts only after the full shingle
sets are compared.

Equal sets are one node from the start, and only nodes that share a bucket with
another are looked at again: their full sets are made once. Bands are taken in
batches. A task gets the nodes of one bucket with their full sets and component
names, compares those of different components and emits only the links that
join components, fewer than nodes; pairs are never listed. A pair belongs to
the first band that it shares, so it is compared once at most. After each batch
the components are contracted, and a bucket whose nodes are in one component is
done. Buckets of any size are cut into blocks: first every node of them meets the
bucket's smallest alone, which joins most copies, then a task takes each two
blocks of the buckets that are left.

``P(no shared band)`` at similarity s is ``(1 - s**ROWS) ** BANDS``: 3.6e-6 at 0.75.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.common import filtered_joins, freed, small_batches, stored, text_bytes
from parcelmart.llm.components import components

ROWS, BANDS = 6, 64
#: Permutations: each gives ROWS*BANDS/2 minima and as many maxima.
PERMUTATIONS = ROWS * BANDS // 2
#: Bands of each batch (up to, exclusive): the first few join most copies, so that later buckets are done.
BATCHES = (4, 16, BANDS)
#: Nodes of a bucket in a block.
BLOCK = 512

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte codes, the odd base and its inverse for word hashes, and odd multipliers: fixed by a seed."""
    rng = np.random.default_rng(20240607)
    codes = rng.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    multipliers = rng.integers(1, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    return codes, np.array([base, pow(base, -1, 1 << 64)], np.uint64), multipliers


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of the text, A-Z lower-cased; words are runs of other than 0x20, 0x09-0x0D."""
    data = np.frombuffer(text.lower(), np.uint8)
    inside = np.concatenate(([False], ~WHITE[data], [False]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    if not len(starts):
        return np.zeros(0, np.uint64)
    codes, (base, inverse), _ = _constants()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * _powers(base, len(data)), dtype=np.uint64, out=sums[1:])
    # Sum of code * base**(place in the word): the same for a word wherever it stands.
    return _mix((sums[ends] - sums[starts]) * _powers(inverse, len(data))[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a shorter text is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mix(total * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - width + 1 + k])
    return np.unique(total)


def min_max_signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minimum and the maximum of the set under every permutation (multiplication by an odd number)."""
    _, _, multipliers = _constants()
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 2048):
        image = multipliers[:, None] * shingles[None, at : at + 2048]
        np.minimum(low, image.min(axis=1), out=low)
        np.maximum(high, image.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key a band: half its values are minima, half maxima, of different permutations."""
    half = ROWS // 2
    lows, highs = low.reshape(half, BANDS), np.roll(high, BANDS // 2).reshape(half, BANDS)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in (*lows, *highs):
        key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + row)
    return key


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=12).digest()


def _signed(size: int):
    """Set size, node and band keys of a text; no words: size 0, no node, no bands."""
    kind = pa.struct([("n", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])

    @arrow_udf("struct<n:bigint,node:binary,bands:array<bigint>>")
    def sign(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            found = shingle_set(text.as_py(), size)
            if len(found):
                bands = band_keys(*min_max_signature(found)).view(np.int64)
                out.append({"n": len(found), "node": node_of(found), "bands": bands})
            else:
                out.append({"n": 0, "node": None, "bands": None})
        return pa.array(out, kind)

    return sign


def _full(size: int):
    """Node, full set and band keys (as bytes) of a text."""
    kind = pa.struct([("node", pa.binary()), ("shingles", pa.binary()), ("bands", pa.binary())])

    @arrow_udf("struct<node:binary,shingles:binary,bands:binary>")
    def full(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            found = shingle_set(text.as_py(), size)
            bands = band_keys(*min_max_signature(found)).tobytes() if len(found) else b""
            out.append({"node": node_of(found), "shingles": found.tobytes(), "bands": bands})
        return pa.array(out, kind)

    # Marked so that Spark does not move it below the join, to documents that no pair needs.
    return full.asNondeterministic()


class Bucket:
    """The nodes of one bucket (or of two of its blocks) while a task compares them."""

    def __init__(self, band: int, within: bool, percent: int):
        self.band, self.within, self.percent = band, within, percent
        self.sides: list[list] = [[], []]

    def add(self, side: int, component: bytes, shingles: bytes, bands: bytes) -> None:
        self.sides[side].append((component, np.frombuffer(shingles, np.uint64), np.frombuffer(bands, np.int64)))

    def links(self) -> list[tuple[bytes, bytes]]:
        """Links between components that join them all as far as the sets allow."""
        left = self.sides[0]
        right = left if self.within else self.sides[1]
        if not left or not right or len({c for c, *_ in left} | {c for c, *_ in right}) < 2:
            return []
        parent: dict[bytes, bytes] = {}

        def root(c: bytes) -> bytes:
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        sizes = np.array([len(s) for _, s, _ in right])
        bands = np.stack([b[: self.band] for *_, b in right])
        out = []
        for at, (component, shingles, own_bands) in enumerate(left):
            n = len(shingles)
            able = (100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n)) & ~(bands == own_bands[: self.band]).any(axis=1)
            if self.within:
                able[: at + 1] = False
            mine = root(component)
            others = [k for k in np.flatnonzero(able) if root(right[k][0]) != mine]
            if not others:
                continue
            values = np.concatenate([right[k][1] for k in others])
            place = np.minimum(np.searchsorted(shingles, values), n - 1)
            starts = np.concatenate(([0], np.cumsum(sizes[others])[:-1]))
            common = np.add.reduceat((shingles[place] == values).astype(np.int64), starts)
            for k, c in zip(others, common):
                if 100 * c >= self.percent * (n + sizes[k] - c):
                    a, b = root(component), root(right[k][0])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((min(a, b), max(a, b)))
        return out


def _compare(percent: int):
    """Rows sorted by bucket and block pair, to links ``a, b`` between components."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written(links: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})

        key, bucket = None, None
        for batch in batches:
            links: list = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j", "band")))
            for row, (now, side) in enumerate(zip(keys, batch.column("side").to_pylist())):
                if now != key:
                    links += bucket.links() if bucket else []
                    key, bucket = now, Bucket(now[3], now[1] == now[2], percent)
                bucket.add(side, *(batch.column(c)[row].as_py() for c in ("component", "shingles", "bands")))
            yield written(links)
        if bucket:
            yield written(bucket.links())

    return compare


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, bands, shingles`` of the ``wanted`` nodes (``node, n, doc, digest``), from the documents that stand for them.

    A text is found by the hash of its id and its digest, so that rows without
    an id are not each other's. The band keys are made again, of these sets
    only, so that none cross a shuffle to get here.
    """
    # The condition holds for all; with one, Spark may filter the texts by the wanted digests before they are shuffled.
    wanted = wanted.where("n > 0").select(F.col("node").alias("want"), F.xxhash64("doc").alias("rep"), "digest")
    docs = docs.select("text", F.xxhash64("doc_id").alias("at"), F.xxhash64("text").alias("own"))
    texts = docs.join(wanted, (F.col("own") == F.col("digest")) & (F.col("at") == F.col("rep")))
    # A repeated row brings the same text; the rows lie together by the keys of the join already. Another text may have the digest.
    texts = texts.select("want", "digest", "rep", "text").distinct()
    sets = texts.select("want", _full(size)(text_bytes()).alias("set")).where(F.col("set")["node"] == F.col("want"))
    return sets.select(F.col("want").alias("node"), F.col("set")["bands"].alias("bands"), F.col("set")["shingles"].alias("shingles"))


def _one_of_equal(spread: DataFrame) -> DataFrame:
    """Of buckets held by the same nodes, told by ``held, x, y``, the one of the smallest band.

    Sets that are alike but not linked share many. Each pair of such nodes is
    compared in the first band it shares, and that one stays.
    """
    one = F.min(F.struct("band", "bucket", "centre")).alias("one")
    return spread.groupBy("held", "x", "y").agg(one).select("held", "one.bucket", "one.centre")


def _shared(buckets: DataFrame) -> DataFrame:
    """The rows of ``buckets`` (``node, band, bucket``, a row once) whose bucket holds more than one node.

    The rows cross one shuffle, by the bucket, and are sorted there; no second
    pass looks the shared buckets up. A group of any size may spill.
    """
    held = buckets.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("bucket")))
    return held.where("held > 1").select("node", "band", "bucket")


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked whose sets of ``size``-word shingles have
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest
    ``doc_id`` reachable, ``kept`` whether that is the row's own.

    Edge cases: a text of fewer words is one shingle; a null or empty text, or
    one without words, has an empty set, is linked with nothing and kept. Rows
    are nodes by their sets, so repeated rows share a component, and rows of one
    ``doc_id`` with different texts are not linked by the id. A null ``doc_id``
    is larger than any other; a component of null ids only has a null
    ``component_id`` and its rows are kept. No rows give no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    signed = docs.select("doc_id", F.xxhash64("text").alias("digest"), _signed(size)(text_bytes()).alias("s"))
    signed = stored(signed.select("doc_id", "digest", "s.n", "s.node", "s.bands"), "signed")
    members = stored(signed.select("doc_id", "n", "node"), "members")
    # A node is represented by a row of its smallest id, if any has one.
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("of")
    nodes = signed.where("n > 0").groupBy("node").agg(first_row, F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = stored(nodes.select("node", "n", F.col("of.doc_id").alias("doc"), F.col("of.digest").alias("digest"), "bands"), "nodes")
    freed(signed)
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = stored(_shared(buckets), "shared")
    labels = stored(shared.select("node").distinct().withColumn("component", F.col("node")), "labels")
    wanted = stored(nodes.select("node", "n", "doc", "digest").join(labels, "node", "left_semi"), "wanted")
    owners = stored(nodes.select("node", "doc"), "owners")
    freed(nodes)
    with filtered_joins(docs.sparkSession):
        sets = stored(_full_sets(docs, wanted, size), "sets")

    def joined(labels: DataFrame, first: int, end: int, stars: bool) -> DataFrame:
        """The labels after the open buckets of some bands were compared; ``stars``: those of several blocks,
        every node with the bucket's smallest alone."""
        placed = shared.where(F.col("band").between(first, end - 1)).join(labels, "node")
        spread = placed.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("held"), F.min("node").alias("centre"),
            F.min("band").alias("band"), *[F.bit_xor(F.xxhash64(F.lit(seed), F.col("node"))).alias(name) for name, seed in (("x", 1), ("y", 2))],
        )
        blocks = F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")
        spread = _one_of_equal(spread.where("low < high"))
        spread = stored(spread.select("bucket", "centre", blocks).where(F.col("blocks") > int(stars)), "open")
        if spread.isEmpty():
            return labels
        rows = placed.join(spread, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        if stars:
            middle = F.col("node") == F.col("centre")
            rows = rows.withColumn("j", F.explode(F.when(middle, every).otherwise(F.array("block"))))
            rows = rows.select("bucket", "band", "node", "component", F.lit(-1).alias("i"), "j", (~middle).cast("int").alias("side"))
        else:
            rows = rows.withColumn("with", F.explode(every))
            rows = rows.select(
                "bucket", "band", "node", "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
                (F.col("block") > F.col("with")).cast("int").alias("side"),
            )
        rows = rows.join(sets, "node").drop("node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        links = stored(rows.mapInArrow(_compare(percent), "a binary, b binary").distinct(), "joined")
        moved = components(links).select(F.col("node").alias("old"), F.col("component").alias("new"))
        labels = labels.join(moved, F.col("component") == F.col("old"), "left")
        return stored(labels.select("node", F.coalesce("new", "component").alias("component")), "labels")

    first = 0
    for end in BATCHES:
        for stars in (True, False):
            labels = joined(labels, first, end, stars)
        first = end

    freed(sets, shared)
    placed = owners.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = stored(placed.join(smallest, "component").select(F.col("node").alias("own"), "component_id"), "named")
    out = members.select("doc_id", "n", "node").join(named, F.col("node") == F.col("own"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
