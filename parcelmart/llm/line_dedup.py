"""Operator 3, line dedup: lines found in many documents stay in one of them.

Normalised lines are exploded and hashed, the documents per hash are counted,
lines over the threshold are dropped, and each document is put together again
by position. Only hashes and ids are shuffled to find the lines; the texts move
once, to meet their own drop list.

Skew: a line that a third of the documents share is counted with a map-side
aggregate. The table of frequent keys is written first, so the join that finds
its holders is planned from its true size: broadcast when small, else a
sort-merge join whose hot partitions Spark splits at run time.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.common import fresh, small_batches, stored, text_bytes

#: Stripped from both ends of a line to form its key: space, tab and 0x0A to 0x0D.
SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key (stripped, A-Z lower-cased); None if it is too short."""
    key = line.strip(SPACE)
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def _keys(min_chars: int):
    @arrow_udf("array<binary>")
    def keys(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            found = {line_key(line, min_chars) for line in text.split(b"\n")}
            out.append([k for k in found if k is not None])
        return pa.array(out, pa.list_(pa.binary()))

    return keys


def _cut(min_chars: int):
    kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.binary())])

    @arrow_udf("struct<n_lines:bigint,n_dropped:bigint,kept:binary>")
    def cut(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out = []
        for text, drop in zip(texts.to_pylist(), drops.to_pylist()):
            lines = text.split(b"\n")
            stay = lines
            if drop:
                drop = set(drop)
                stay = [line for line in lines if line_key(line, min_chars) not in drop]
            out.append({"n_lines": len(lines), "n_dropped": len(lines) - len(stay), "kept": b"\n".join(stay)})
        return pa.array(out, kind)

    return cut


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` cut, plus ``n_lines`` and ``n_dropped``.

    A key of at least ``min_chars`` code points held by at least ``min_docs``
    documents loses its lines everywhere but in the largest ``doc_id`` holding
    it, where all of them stay.

    Edge cases: a null or empty text is one empty line (a null text comes back
    empty). Rows with one ``doc_id`` count as one document; so do all rows whose
    ``doc_id`` is null, and they never hold the largest. No rows give no rows. Extra
    columns pass through; input columns called ``n_lines`` or ``n_dropped`` are
    replaced.
    """
    small_batches(docs.sparkSession)
    exploded = docs.select("doc_id", F.explode(_keys(min_chars)(text_bytes())).alias("key"))
    holders = stored(exploded.distinct(), "line-holders")
    frequent = stored(
        holders.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs),
        "frequent-lines",
    )
    drops = (
        holders.join(frequent, "key")
        .where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper")))
        .groupBy(F.col("doc_id").alias("holder"))
        .agg(F.collect_set("key").alias("drop"))
    )
    docs = docs.drop("n_lines", "n_dropped")
    drop, cut = fresh("drop", docs), fresh("cut", docs)
    drops = drops.select(F.col("holder").alias(fresh("holder", docs)), F.col("drop").alias(drop))
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops[drops.columns[0]]), "left")
    out = joined.select(*docs.columns, _cut(min_chars)(text_bytes(), F.col(drop)).alias(cut))
    return out.select(
        *[F.col(cut)["kept"].cast("string").alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.col(cut)["n_lines"].alias("n_lines"),
        F.col(cut)["n_dropped"].alias("n_dropped"),
    )
