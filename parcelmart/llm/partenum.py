"""Operator 11, an exact Jaccard join of n-gram sets by PartEnum signatures.

Similar sets differ in few elements, and in proportion to their size. So sizes
are cut into bands ``[l, r]`` with ``percent * r <= 100 * l``: sets that may
link are of one band or of two neighbours, and a set is signed for its own band
and for the next. Two sets joined under a band whose largest size is ``r``
differ in at most ``d = 2r(100-percent) / (100+percent)`` elements.

The feature domain (the hashes of all n-grams) is cut into ``n1`` parts and each
of them into ``n2``. As ``n1 * (SPARE + 1) > d``, two linked sets differ in at
most ``SPARE`` elements of some part, and so agree in some subset of
``n2 - SPARE`` of its cells. All these subsets are enumerated; a signature is
the hash of a set's elements in one of them. No linked pair is missed.

Where a subset holds none of a set's elements, the signature would be one of
nothing, shared by very many sets. It is left out, and the set is signed under
another partition of the domain as well. A pair that agrees in nothing but empty
subsets has this on both sides, so it meets under the next partition; under
the last one (``SCHEMES``), empty subsets are signed like any other.

Equal sets are one node from the start. Nodes that share a signature are first
compared with its smallest node (a star), for ``STARS`` rounds, and the
components are contracted after each; what is left of a signature then, in more
than one component, is compared in blocks, a task for each two blocks. A pair is
looked at by its sketches first, the numbers of elements in ``PLACES`` places:
sets differ in at least as many elements as their sketches do, so a pair whose
sketches differ too much is out for certain. Only pairs that are left meet with
their full sets, which decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.common import filtered_joins, stored, text_bytes
from parcelmart.llm.components import components
from parcelmart.llm.near_dedup import node_of, shingle_set

#: Cells of a part, and how many of them may differ.
CELLS, SPARE = 3, 1
#: Partitions of the feature domain, each by its own seed.
SCHEMES = 4
#: Rounds of comparing with the smallest node of a signature.
STARS = 4
#: Parts of a star at most, and nodes of a block.
BLOCK = 512
#: Nodes of a star from which on it is dealt to several parts: each part gets the hub's set.
PART = 32
#: Places of a sketch, a byte each.
PLACES = 128

SUBSETS = list(combinations(range(CELLS), CELLS - SPARE))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=100_000)
def band_of(size: int, percent: int) -> tuple[int, int, int]:
    """Number and largest size of the band of ``size``, and the largest size of the next one."""
    number, largest = 0, 0
    while largest < size:
        number, largest = number + 1, (largest + 1) * 100 // percent
    return number, largest, (largest + 1) * 100 // percent


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a set (distinct 64-bit hashes): two sets that link share one."""
    if not len(elements):
        return elements
    number, largest, after = band_of(len(elements), percent)
    out = []
    for band, r in ((number, largest), (number + 1, after)):
        apart = 2 * r * (100 - percent) // (100 + percent)
        if not apart:
            continue  # only equal sets link in this band, and they are one node
        parts = apart // (SPARE + 1) + 1
        for scheme in range(SCHEMES):
            seed = _mixed(np.array([band * SCHEMES + scheme + 1], np.uint64))
            image = _mixed(elements ^ seed)
            cell = (image % np.uint64(parts * CELLS)).astype(np.intp)
            sums = np.zeros(parts * CELLS, np.uint64)
            np.add.at(sums, cell, _mixed(image + seed))
            sums, held = sums.reshape(parts, CELLS), np.bincount(cell, minlength=parts * CELLS).reshape(parts, CELLS)
            place = seed + np.arange(parts * len(SUBSETS), dtype=np.uint64)
            signed = np.concatenate([sums[:, s].sum(axis=1, dtype=np.uint64) for s in SUBSETS])
            filled = np.concatenate([held[:, s].any(axis=1) for s in SUBSETS])
            signed = _mixed(_mixed(signed) + place)
            if filled.all() or scheme == SCHEMES - 1:
                out.append(signed)
                break
            out.append(signed[filled])
    return np.concatenate(out) if out else elements[:0]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Do two sorted sets have ``100 * intersection >= percent * union``?"""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _node(size: int):
    """Set size and node of a text; no words: size 0, no node."""
    kind = pa.struct([("n", pa.int64()), ("node", pa.binary())])

    @arrow_udf("struct<n:bigint,node:binary>")
    def named(texts: pa.Array) -> pa.Array:
        found = (shingle_set(text.as_py(), size) for text in texts)
        return pa.array([{"n": len(f), "node": node_of(f) if len(f) else None} for f in found], kind)

    return named


def _signed(size: int, percent: int):
    """Node and signatures of a text; no words: no node, no signatures."""
    kind = pa.struct([("node", pa.binary()), ("signatures", pa.list_(pa.int64()))])

    @arrow_udf("struct<node:binary,signatures:array<bigint>>")
    def sign(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            found = shingle_set(text.as_py(), size)
            node = node_of(found) if len(found) else None
            out.append({"node": node, "signatures": signatures(found, percent).view(np.int64)})
        return pa.array(out, kind)

    # Marked so that Spark runs it once for both columns.
    return sign.asNondeterministic()


def sketch(elements: np.ndarray) -> np.ndarray:
    """How many elements fall on each place, 255 at most."""
    return np.minimum(np.bincount((elements & np.uint64(PLACES - 1)).astype(np.intp), minlength=PLACES), 255).astype(np.uint8)


def near(sketches: np.ndarray, others: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, percent: int) -> np.ndarray:
    """May the sets be linked? Never false of sets that are; row by row, or one against all."""
    apart = np.abs(sketches.astype(np.int16) - others).sum(axis=-1, dtype=np.int64)
    return (100 + percent) * apart <= (100 - percent) * (sizes + other_sizes)


def _sets(size: int):
    """Node, sketch and full set (as bytes) of a text."""
    kind = pa.struct([("node", pa.binary()), ("sketch", pa.binary()), ("elements", pa.binary())])

    @arrow_udf("struct<node:binary,sketch:binary,elements:binary>")
    def made(texts: pa.Array) -> pa.Array:
        found = (shingle_set(text.as_py(), size) for text in texts)
        return pa.array([{"node": node_of(f), "sketch": sketch(f).tobytes(), "elements": f.tobytes()} for f in found], kind)

    # Marked so that Spark does not move it below the join, to texts that no pair needs.
    return made.asNondeterministic()


def _near(percent: int):
    @arrow_udf("boolean")
    def able(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.bool_())
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, PLACES) for x in (a, b))
        return pa.array(near(a, b, n_a.to_numpy(), n_b.to_numpy(), percent))

    return able


def _links(pairs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in pairs], pa.binary()), "b": pa.array([b for _, b in pairs], pa.binary())})


def _star(percent: int):
    """Rows sorted by ``hub, part, side``; the hub's own row (side 0) comes first. Links of the hub."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, held = None, None
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("hub", "side", "node", "elements")))
            for now, side, node, elements in rows:
                elements = np.frombuffer(elements, np.uint64)
                if not side:
                    hub, held = now, elements
                elif hub == now and linked(held, elements, percent):
                    out.append((now, node))
            yield _links(out)

    return compare


def _blocks(percent: int):
    """Rows sorted by ``signature, i, j``: the pairs of different components whose sketches are near."""

    def pairs(key: tuple, sides: list) -> list:
        left = sides[0]
        right = left if key[1] == key[2] else sides[1]
        if not left or not right:
            return []
        sketches = np.frombuffer(b"".join(r[2] for r in right), np.uint8).reshape(-1, PLACES)
        sizes, names = np.array([r[3] for r in right]), {c: i for i, c in enumerate(sorted({r[1] for r in left + right}))}
        component = np.array([names[r[1]] for r in right])
        out = []
        for at, (node, own, its, n) in enumerate(left):
            able = near(np.frombuffer(its, np.uint8), sketches, n, sizes, percent) & (component != names[own])
            if left is right:
                able[:at] = False
            out += [(min(node, right[k][0]), max(node, right[k][0])) for k in np.flatnonzero(able)]
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, [[], []]
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("signature", "i", "j", "side", "node", "component", "sketch", "n"))
            for signature, i, j, side, *row in zip(*columns):
                if key != (signature, i, j):
                    out += pairs(key, sides) if key else []
                    key, sides = (signature, i, j), [[], []]
                sides[side].append(row)
            yield _links(out)
        if key:
            yield _links(pairs(key, sides))

    return compare


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, n, sketch, elements`` of the ``wanted`` nodes, from one text of each.

    Rows are found by the hashes of the text and the id, so that null or
    repeated ids bring along no other texts. Of repeated
    rows one stays; they lie together by the keys of the join already.
    """
    # The condition holds for all; with one, Spark may filter the texts by the wanted hashes before they are shuffled.
    wanted = wanted.where("n > 0").select(F.col("node").alias("want"), "n", F.col("text_hash").alias("want_hash"), F.xxhash64("at").alias("want_at"))
    docs = docs.withColumn("text_hash", F.xxhash64(text_bytes())).withColumn("at", F.xxhash64("doc_id"))
    found = docs.join(wanted, (F.col("text_hash") == F.col("want_hash")) & (F.col("at") == F.col("want_at")))
    found = found.select("want", "n", "want_hash", "want_at", "text").distinct()
    found = found.select("want", "n", _sets(size)(text_bytes()).alias("made")).where(F.col("made")["node"] == F.col("want"))
    return found.select(F.col("want").alias("node"), "n", F.col("made")["sketch"].alias("sketch"), F.col("made")["elements"].alias("elements"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (``hub, node``) that link by their full sets: ``a, b``.

    A hub's set is sent once to each part of its star, one for ``PART`` nodes and at most ``BLOCK``.
    """
    stars = pairs.groupBy(F.col("hub").alias("of")).agg(F.least(F.lit(BLOCK), F.ceil(F.count(F.lit(1)) / PART)).alias("parts"))
    pairs = pairs.join(stars, F.col("hub") == F.col("of")).select("hub", "node", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    full = sets.select("node", "elements")
    rows = pairs.join(full, "node").select("hub", "part", F.lit(1).alias("side"), "node", "elements")
    hubs = pairs.select("hub", "part").distinct().join(full, F.col("hub") == F.col("node"))
    rows = rows.unionByName(hubs.select("hub", "part", F.lit(0).alias("side"), "node", "elements"))
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "side")
    return rows.mapInArrow(_star(percent), "a binary, b binary")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after ``links`` between nodes."""
    links = stored(links, "linked")
    links = links.join(labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
    links = links.join(labels.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
    moved = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("node").alias("old"), F.col("component").alias("new"))
    out = labels.join(moved, F.col("component") == F.col("old"), "left")
    return stored(out.select("node", F.coalesce("new", "component").alias("component")), "labels")


def _shared(signs: DataFrame) -> DataFrame:
    """The rows of ``signs`` (``signature, short``) whose signature another node has too.

    The rows cross one shuffle, by the signature, and are sorted there; no second
    pass looks the shared signatures up. A group of any size may spill.
    """
    same = Window.partitionBy("signature")
    held = signs.withColumn("low", F.min("short").over(same)).withColumn("high", F.max("short").over(same))
    return held.where("low < high").select("signature", "short")


def _representative(shared: DataFrame) -> DataFrame:
    """Of signatures held by the same nodes (long sets share thousands) the rows of one, each once.

    The rows lie by their signature, so that only the last step shuffles them,
    once summed up.
    """
    same = Window.partitionBy("signature")
    rows = shared.distinct().withColumn("held", F.count(F.lit(1)).over(same))
    for seed, name in ((1, "x"), (2, "y")):
        rows = rows.withColumn(name, F.bit_xor(F.xxhash64(F.lit(seed), F.col("short"))).over(same))
    return rows.groupBy("held", "x", "y", "short").agg(F.min("signature").alias("signature")).select("signature", "short")


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``shared`` whose signature holds more than one component, with their components and that signature's totals.

    Of signatures held by the same nodes (long sets share thousands) one stays; a 128-bit exclusive-or names the nodes.
    """
    placed = shared.join(labels, "node")
    spread = placed.groupBy("signature").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("hub"),
        F.min_by("component", "node").alias("hub_component"), F.count(F.lit(1)).alias("held"),
        *[F.bit_xor(F.xxhash64(F.lit(seed), F.col("node"))).alias(name) for name, seed in (("x", 1), ("y", 2))],
    )
    one = F.min(F.struct("signature", "hub", "hub_component")).alias("one")
    spread = spread.where("low < high").groupBy("held", "x", "y").agg(one).select("held", "one.*")
    return placed.join(spread, "signature")


def jaccard_components(docs: DataFrame, percent: int = 90, size: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Documents link whose sets of ``size``-word shingles have ``100 *
    intersection >= percent * union``; ``component_id`` is the smallest
    ``doc_id`` reachable, the row's own included.

    Edge cases: a text of fewer words is one shingle; a null or empty text, or
    one without words, has an empty set and is linked with nothing. Repeated
    rows and equal texts are one node and share a component; rows of one
    ``doc_id`` with different texts are not linked by the id. A null ``doc_id``
    is larger than any other; a component of null ids only has a null
    ``component_id``. A very long text has signatures in proportion to its
    words. No rows give no rows. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    named = docs.select("doc_id", F.xxhash64(text_bytes()).alias("text_hash"), _node(size)(text_bytes()).alias("s"))
    members = stored(named.select("doc_id", "text_hash", "s.n", "s.node"), "members")
    nodes = members.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.min(F.struct("text_hash", "doc_id")).alias("rep")
    )
    nodes = stored(nodes.withColumn("short", F.xxhash64("node")), "nodes")
    # While most signatures are found to be a node's own, nodes go by a short name; one shared by two nodes only brings both along.
    # Signatures go from the texts to the shuffle and are written nowhere else: they are as large as the texts.
    signed = docs.select(_signed(size, percent)(text_bytes()).alias("s"))
    signs = signed.select(F.xxhash64("s.node").alias("short"), F.explode("s.signatures").alias("signature"))
    shared = _representative(_shared(signs))
    shared = stored(shared.join(nodes.select("short", "node"), "short").select("signature", "node"), "shared")
    labels = stored(shared.select("node").distinct().withColumn("component", F.col("node")), "labels")
    wanted = nodes.join(labels, "node", "left_semi").select("node", "n", F.col("rep")["text_hash"].alias("text_hash"), F.col("rep")["doc_id"].alias("at"))
    wanted = stored(wanted, "wanted")
    with filtered_joins(docs.sparkSession):
        sets = stored(_full_sets(docs, wanted, size), "sets")

    sketches = sets.select("node", "n", "sketch")
    for _ in range(STARS):
        left = stored(_open(shared, labels), "open")
        if left.isEmpty():
            break
        # Each pair of a hub and a node once, whatever number of signatures they share.
        pairs = left.where("component <> hub_component").select("hub", "node").distinct().join(sketches, "node")
        hubs = sketches.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
        pairs = pairs.join(hubs, "hub").where(_near(percent)("sketch", "hub_sketch", "n", "hub_n")).select("hub", "node")
        labels = _merged(labels, _linked(stored(pairs, "pairs"), sets, percent))
        shared = stored(left.where("node <> hub").select("signature", "node"), "shared")

    left = _open(shared, labels)
    left = left.withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
    rows = stored(left.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "open")
    if not rows.isEmpty():
        rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select(
            "signature", "node", "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
            (F.col("block") > F.col("with")).cast("int").alias("side"),
        )
        rows = rows.join(sketches, "node").repartition("signature", "i", "j").sortWithinPartitions("signature", "i", "j")
        pairs = rows.mapInArrow(_blocks(percent), "a binary, b binary").distinct()
        pairs = stored(pairs.select(F.col("a").alias("hub"), F.col("b").alias("node")), "pairs")
        labels = _merged(labels, _linked(pairs, sets, percent))

    placed = nodes.select("node", "doc").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = stored(placed.join(smallest, "component").select(F.col("node").alias("own"), "component_id"), "named")
    out = members.select("doc_id", "n", "node").join(named, F.col("node") == F.col("own"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
