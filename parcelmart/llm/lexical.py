"""Operator 13, ranked lexical search over deduplicated bags of words.

Only the terms of the items matter to a score, and a document's length only by
the whole number ``m``. So each document is restricted to the vocabulary of the
items: its bag, the ascending ids of its terms with their counts. Documents with
the same bag and ``m`` are one class: they are hashed, and the classes formed by
comparing the bags themselves. A class is scored once against all items, its
members share the score. Each task keeps the ``k`` best classes of an item, as
no more can hold one of its ``k`` best documents: equal scores go by the
smallest member first. The members of the classes chosen are then listed by
ascending id.

Items come in blocks of about ``BLOCK`` (item, term) pairs. One block at a time
is sent to the tasks, so what is broadcast has a bound however many items there
are; every block meets all documents and its result is written before the next.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.common import stored, text_bytes

#: (item, term) pairs of the items that are searched for at a time.
BLOCK = 400_000
#: Scores (classes times items) that a task holds at a time.
CELLS = 2_000_000
#: (class, term, item) triples that a task holds at a time.
EXPANDED = 2_000_000

#: ASCII letters and digits, and all that is not ASCII, in UTF-8; texts are lower-cased before.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text, A-Z lower-cased, in order."""
    return TERM.findall(text.lower())


def _distinct_terms():
    @arrow_udf("array<binary>")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(terms_of(t.as_py()))) for t in texts], pa.list_(pa.binary()))

    return distinct


def _bags(vocabulary):
    """``n`` (all terms of a text), and the ids and counts of those in the (broadcast) vocabulary."""
    kind = pa.struct([("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    @arrow_udf("struct<n:bigint,terms:array<int>,counts:array<int>>")
    def bag(texts: pa.Array) -> pa.Array:
        ids, out = vocabulary.value, []
        for text in texts:
            found = Counter(terms_of(text.as_py()))
            held = sorted((ids[t], c) for t, c in found.items() if t in ids)
            out.append({"n": sum(found.values()), "terms": [t for t, _ in held], "counts": [c for _, c in held]})
        return pa.array(out, kind)

    return bag


class Postings:
    """The items of a block by term: ``items[starts[t]:starts[t + 1]]`` hold term ``t``, whose weight is ``weights[t]``."""

    def __init__(self, n_items: int, starts: np.ndarray, items: np.ndarray, weights: np.ndarray):
        self.n_items, self.starts, self.items, self.weights = n_items, starts, items, weights

    def scores(self, m: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Scores (classes x items) of classes with ``m``, whose terms are given as (row, term, count)."""
        worth = self.weights[term] * ((1_000_000_000 * count) // (1000 * count + 20 * m[row]))
        held = self.starts[term + 1] - self.starts[term]
        out, ends = np.zeros(len(m) * self.n_items, np.int64), np.cumsum(held)
        at = 0
        while at < len(row):
            # As many (row, term) pairs as meet about EXPANDED items together.
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + EXPANDED, side="right")))
            n = held[at:end]
            place = np.repeat(self.starts[term[at:end]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            np.add.at(out, np.repeat(row[at:end], n) * self.n_items + self.items[place], np.repeat(worth[at:end], n))
            at = end
        return out.reshape(len(m), self.n_items)


class Best:
    """The ``k`` best classes of every item so far: by score, then by the smallest member (null last)."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.zeros(n_items, np.int64)
        self.item, self.score, self.first, self.key = (np.zeros(0, np.int64) for _ in range(4))
        self.no_id = np.zeros(0, bool)

    def add(self, scores: np.ndarray, first: np.ndarray, no_id: np.ndarray, key: np.ndarray) -> None:
        # At least the lowest score kept: a tie may have the smaller id.
        row, item = np.nonzero((scores > 0) & (scores >= self.floor))
        self.item, self.score = np.concatenate((self.item, item)), np.concatenate((self.score, scores[row, item]))
        self.first, self.key = np.concatenate((self.first, first[row])), np.concatenate((self.key, key[row]))
        self.no_id = np.concatenate((self.no_id, no_id[row]))
        order = np.lexsort((self.key, self.first, self.no_id, -self.score, self.item))
        item = self.item[order]
        begin = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
        order = order[place < self.k]
        for name in ("item", "score", "first", "key", "no_id"):
            setattr(self, name, getattr(self, name)[order])
        full = np.bincount(self.item, minlength=len(self.floor)) == self.k
        lowest = np.full(len(self.floor), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.item, self.score)
        self.floor = np.where(full, lowest, 0)


def _score(postings, k: int):
    """Classes (``key, first, m, terms, counts``) to a task's best of each item."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = postings.value
        best, step = Best(held.n_items, k), max(1, CELLS // held.n_items)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                terms, counts = batch.column("terms"), batch.column("counts")
                row = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
                m, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("m", "key"))
                no_id = batch.column("first").is_null().to_numpy(zero_copy_only=False)
                first = batch.column("first").fill_null(0).to_numpy(zero_copy_only=False)
                scores = held.scores(m, row, terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64))
                best.add(scores, first, no_id, key)
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(best.item, pa.int64()), "score": pa.array(best.score, pa.int64()),
            "first": pa.array(best.first, pa.int64(), mask=best.no_id), "key": pa.array(best.key, pa.int64()),
        })

    return score


def _best_documents(block: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` for the items of one block (``item_id, term`` pairs)."""
    spark = docs.sparkSession
    pairs = block.select("item_id", "term").toArrow()  # a block: bounded
    terms = {t: i for i, t in enumerate(sorted(set(pairs["term"].to_pylist())))}
    names = sorted(set(pairs["item_id"].to_pylist()), key=lambda i: (i is None, i))
    number = {n: i for i, n in enumerate(names)}
    term = np.array([terms[t] for t in pairs["term"].to_pylist()], np.int64)
    item = np.array([number[i] for i in pairs["item_id"].to_pylist()], np.int64)
    item, starts = item[np.argsort(term, kind="stable")], np.searchsorted(np.sort(term), np.arange(len(terms) + 1))

    vocabulary = spark.sparkContext.broadcast(terms)
    bags = docs.select("doc_id", _bags(vocabulary)(text_bytes()).alias("b")).select("doc_id", "b.n", "b.terms", "b.counts")
    bags = stored(bags, "bags")
    n_docs, length = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # In decimals, as 50 * n * N may pass 64 bits.
    product = F.lit(50).cast("decimal(2,0)") * F.col("n").cast("decimal(14,0)") * F.lit(n_docs).cast("decimal(18,0)")
    m = 50 + F.call_function("div", product, F.lit(max(length, 1)).cast("decimal(19,0)"))
    held = bags.where(F.size("terms") > 0).select("doc_id", m.cast("bigint").alias("m"), "terms", "counts")
    held = held.withColumn("key", F.xxhash64("m", "terms", "counts"))

    classes = held.groupBy("key", "m", "terms", "counts").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("members"))
    classes = stored(classes, "classes")
    frequency = classes.select(F.explode("terms").alias("term"), "members").groupBy("term").agg(F.sum("members").alias("df"))
    ratio = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)
    weights = np.zeros(len(terms), np.int64)
    for row in frequency.select("term", F.floor(1000 * F.log(ratio)).cast("bigint").alias("w")).toLocalIterator():  # the vocabulary of a block
        weights[row.term] = row.w

    postings = spark.sparkContext.broadcast(Postings(len(names), starts, item, weights))
    best = classes.select("key", "first", "m", "terms", "counts").mapInArrow(_score(postings, k), "item bigint, score bigint, first bigint, key bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "key")
    best = stored(best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("item", "score", "first", "key"), "best")

    same = lambda a, b, columns: reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])
    chosen = best.select("key", "first").distinct()
    chosen = stored(classes.join(chosen, same(classes, chosen, ["key", "first"])).select(classes["key"], classes["first"], "m", "terms", "counts"), "chosen")
    members = held.join(chosen, (held["key"] == chosen["key"]) & same(held, chosen, ["m", "terms", "counts"])).select(chosen["key"], chosen["first"], "doc_id")
    listed = Window.partitionBy("key", "first").orderBy(F.asc_nulls_last("doc_id"))
    members = members.withColumn("place", F.row_number().over(listed)).where(F.col("place") <= k)
    found = best.join(members, same(best, members, ["key", "first"])).select("item", "doc_id", "score")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    kind = block.schema["item_id"].dataType
    numbers = spark.createDataFrame([(i, n) for i, n in enumerate(names)], f"item bigint, item_id {kind.simpleString()}")
    out = stored(found.join(numbers, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    vocabulary.unpersist()
    postings.unpersist()
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    A term's weight is ``floor(1000 ln((2N + 2) / (2df + 1)))``, a document's
    ``m`` is ``50 + 50nN div L``, and its score sums ``weight * (10**9 tf div
    (1000 tf + 20 m))`` over the item's distinct terms; equal scores go by ascending ``doc_id``.

    Edge cases: a null or empty text has no terms; such documents count in
    nothing and such items have no rows. Every row of ``docs`` is a document:
    repeated rows are ranked one after the other, a null ``doc_id`` after all
    others of its score. Rows of one ``item_id`` are one item with the terms of
    all of them, those of a null one too. With fewer than ``k`` documents above 0 all are returned.
    Empty tables give no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    pairs = items.select("item_id", F.explode(_distinct_terms()(text_bytes())).alias("term")).distinct()
    pairs = stored(pairs, "item-terms")
    blocks = -(-pairs.count() // block)
    docs = docs.select("doc_id", "text")
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1))))
    filled = sorted(r.block for r in pairs.select("block").distinct().collect())  # numbers of blocks
    done = [_best_documents(pairs.where(F.col("block") == b), docs, k) for b in filled]
    if not done:
        kinds = [items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    return reduce(DataFrame.unionByName, done)
