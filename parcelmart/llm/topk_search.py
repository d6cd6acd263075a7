"""Operator 6, exact top-k inner-product search with block-at-a-time pruning.

Candidates are cut into blocks of consecutive ids. A block keeps, per
dimension (term), its largest and smallest weight, and a forward index: the
vectors themselves as one matrix. For a query the block's bound is the sum over
the terms of the larger product with either extreme. Blocks are visited by
falling bound and scored through their forward index, until the bounds fall
below the query's kth score.

Blocks and queries are dealt into groups of bounded size; a task gets one group
of each, however many there are. The first wave searches one group of blocks
for all queries; the kth scores found there are floors that let the tasks of
the second wave stop early. The tasks' results are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.common import small_batches, stored

#: Vectors in a block, blocks in a group (a task's share), queries in a group.
BLOCK, GROUP, QUERIES = 256, 32, 512
EXACT = float(1 << 53)
LONG = (-(1 << 63), (1 << 63) - 1)

BLOCKS = "part int, block int, top array<double>, bottom array<double>, ids binary, vectors binary, terms int"
BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("top", pa.list_(pa.float64())), ("bottom", pa.list_(pa.float64())),
    ("ids", pa.binary()), ("vectors", pa.binary()), ("terms", pa.int32()),
])
SCORED = "query_id bigint, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, scale: int = 256, repeats: bool = False) -> DataFrame:
    """``vec_id, vector``: floor(scale * x) of each component, as double (whole numbers); unusable rows go.

    Unusable: a null id or vector, or a null or non-finite component. Identical
    rows count once, or with ``repeats`` as often as they are there. A product beyond the long range stops at its end.
    """
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    usable = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    usable = usable.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    whole = usable.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("vector"))
    return whole if repeats else whole.distinct()


def _matrix(rows: list, width: int) -> np.ndarray:
    """Vectors as rows, the shorter ones filled with zeros."""
    out = np.zeros((len(rows), width))
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def blocks_of(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """The candidates as blocks of consecutive ids: term maxima and minima, ids and forward index."""
    from pyspark import TaskContext

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, rows = TaskContext.get().partitionId(), 0, [], []

        def close() -> pa.RecordBatch:
            m = _matrix(rows, max(map(len, rows)))
            row = {"part": part, "block": number, "top": m.max(axis=0), "bottom": m.min(axis=0),
                   "ids": np.array(ids, np.int64).tobytes(), "vectors": m.tobytes(), "terms": m.shape[1]}
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(vec_id)
                rows.append(vector)
                if len(rows) == block:
                    yield close()
                    number, ids, rows = number + 1, [], []
        if rows:
            yield close()

    return vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id").mapInArrow(cut, BLOCKS)


def inner_products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products of two matrices of whole doubles; beyond the long range they stop at its ends."""
    width = min(q.shape[1], m.shape[1])
    q, m = q[:, :width], m[:, :width]
    if not width:
        return np.zeros((len(q), len(m)), np.int64)
    if np.abs(q).max(initial=0) * np.abs(m).max(initial=0) * width < EXACT:
        return (q @ m.T).astype(np.int64)
    big = np.frompyfunc(int, 1, 1)
    out = big(q).dot(big(m).T)
    return np.clip(out, *LONG).astype(np.int64)


def bounds_of(q: np.ndarray, top: list, bottom: list) -> np.ndarray:
    """Bound of each query (row) on each block (column); never below an attainable score."""
    width = max([q.shape[1], *map(len, top)])
    q = _matrix(list(q), width)
    high, low = _matrix(top, width), _matrix(bottom, width)
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    size = np.abs(q).sum(axis=1)[:, None] * np.maximum(np.abs(high), np.abs(low)).max(axis=1, initial=0)[None, :]
    return bound + size * 2.0**-40  # above what rounding may take off a large sum


class Best:
    """A query's k best so far: scores fall, ties by id."""

    def __init__(self, k: int, floor: float):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def kth(self) -> float:
        """The score to reach; a little lower where doubles do not hold every integer."""
        score = max(self.floor, float(self.scores[-1])) if len(self.scores) == self.k else self.floor
        return score if abs(score) < EXACT else float(np.nextafter(score, -np.inf))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        near = scores >= self.kth()
        scores, ids = np.concatenate((self.scores, scores[near])), np.concatenate((self.ids, ids[near]))
        order = np.lexsort((ids, ~scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_group(queries: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """Top k of each query among the blocks' vectors, best bound first, until no bound reaches the kth score."""
    if queries.empty or blocks.empty:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
    q = _matrix(list(queries["vector"]), max(map(len, queries["vector"])))
    own = queries["query_id"].to_numpy()
    best = [Best(k, floor) for floor in queries["floor"].fillna(-np.inf)]
    bounds = bounds_of(q, list(blocks["top"]), list(blocks["bottom"]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    ids = [np.frombuffer(b, np.int64) for b in blocks["ids"]]
    index = [np.frombuffer(v, np.float64).reshape(-1, t) for v, t in zip(blocks["vectors"], blocks["terms"])]
    alive = np.arange(len(q))
    for turn in range(order.shape[1]):
        # At the turn-th block of each query; a bound below the kth score ends the query.
        alive = np.array([a for a in alive if bounds[a, order[a, turn]] >= best[a].kth()], int)
        for block in np.unique(order[alive, turn]):
            mine = alive[order[alive, turn] == block]
            scores = inner_products(q[mine], index[block])
            for row, a in enumerate(mine):
                other = ids[block] != own[a]
                best[a].add(scores[row][other], ids[block][other])
    return pd.DataFrame({
        "query_id": np.concatenate([np.full(len(b.ids), i) for i, b in zip(own, best)]),
        "vec_id": np.concatenate([b.ids for b in best]),
        "score": np.concatenate([b.scores for b in best]),
    })


def _wave(asked: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """A task for each group of queries with each group of blocks."""

    def search(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        return search_group(queries, blocks, k)

    keys = ["group", "query_group"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, SCORED)


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 5, block: int = BLOCK, group: int = GROUP, query_group: int = QUERIES
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest exact scores, ties to the smaller ``vec_id``.

    ``queries`` and ``vectors`` come from ``quantised``. Candidates are all
    vectors but those with the query's own id.

    Edge cases: with fewer than ``k`` candidates all are returned. Vectors of
    different lengths are compared over their common components. Ids with
    several rows are candidates several times and, as queries,
    ranked over all their rows together. Empty tables give no rows. Extra
    columns are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    blocks = stored(blocks_of(vectors, block), "blocks")
    groups, query_groups = (-(-n // size) for n, size in ((blocks.count(), group), (queries.count(), query_group)))
    if not groups or not query_groups:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = blocks.withColumn("group", F.pmod(F.xxhash64("part", "block"), F.lit(groups)).cast("int"))
    blocks = blocks.withColumn("query_group", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1))))
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector")
    asked = asked.withColumn("query_group", F.pmod(F.xxhash64("query_id"), F.lit(query_groups)).cast("int"))

    first = asked.withColumn("floor", F.lit(None).cast("double")).withColumn("group", F.lit(0))
    first = stored(_best(_wave(first, blocks.where("group = 0"), k), k).select("query_id", "vec_id", "score", "rank"), "first")
    floors = first.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))
    found = first.select("query_id", "vec_id", "score")
    if groups > 1:
        rest = asked.join(floors, "query_id", "left").withColumn("group", F.explode(F.sequence(F.lit(1), F.lit(groups - 1))))
        found = found.union(_wave(rest, blocks.where("group > 0"), k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
