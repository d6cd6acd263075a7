"""Operator 10, benchmark decontamination by Wu-Manber multi-pattern search.

The symbols are words, the patterns are the benchmark's windows. For the
patterns of one length a shift table tells, for the block of two words under
the cursor, how many words can be skipped; where the shift is zero, the block
is a suffix of some patterns, its bucket lists them and each is compared
directly. Documents are searched where they lie: no shuffle at all.

The patterns are taken in blocks of a fixed number of windows, one pass over
the documents a block, so neither the driver nor a task holds more than one
block; a benchmark of ordinary size is a single block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.common import fresh, small_batches, text_bytes

#: Every ASCII byte that is no letter or digit separates words; A-Z become a-z; other bytes belong to words.
WORD_BYTES = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)

#: Windows in a block: at ten words each some 200 MB of tables in a task at most.
BLOCK_WINDOWS = 200_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WuManber:
    """Search tables for windows of words, by window length."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[int]]):
        by_length: dict[int, list] = defaultdict(list)
        for window, items in windows.items():
            by_length[len(window)].append((list(window), items))
        self.classes = [self._tables(m, patterns) for m, patterns in sorted(by_length.items())]

    @staticmethod
    def _tables(m: int, patterns: list) -> tuple:
        """``(m, B, far, shift, buckets)``: far is the shift of a block that no pattern holds."""
        b = min(2, m)
        far = m - b + 1
        shift: dict[tuple, int] = {}
        buckets: dict[tuple, list] = defaultdict(list)
        for words, items in patterns:
            for end in range(b, m + 1):
                block = tuple(words[end - b : end])
                shift[block] = min(shift.get(block, far), m - end)
            buckets[tuple(words[m - b :])].append((words, items))
        return m, b, far, shift, dict(buckets)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """``(start, end, items)`` of every occurrence of every window."""
        n = len(words)
        for m, b, far, shift, buckets in self.classes:
            i = m
            while i <= n:
                block = (words[i - 2], words[i - 1]) if b == 2 else (words[i - 1],)
                skip = shift.get(block, far)
                if skip:
                    i += skip
                    continue
                for pattern, items in buckets[block]:
                    if words[i - m : i] == pattern:
                        yield i - m, i, items
                i += 1


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """``(window, item_id)`` rows, distinct; words joined by spaces. A shorter item is one window."""

    @arrow_udf("array<string>")
    def windows(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            words = words_of(text)
            cut = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
            out.append(list({b" ".join(w).decode("utf-8", "replace") for w in cut}))
        return pa.array(out, pa.list_(pa.string()))

    rows = benchmark.where(F.col("item_id").isNotNull()).select("item_id", F.explode(windows(text_bytes())).alias("window"))
    return rows.distinct()


def _blocks(windows: DataFrame, block_windows: int) -> Iterator[dict[tuple[bytes, ...], list[int]]]:
    """The windows in blocks; the driver holds one block and one fetched partition."""
    block: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
    rows: Iterator[Row] = windows.toLocalIterator()
    count = 0
    for row in rows:
        block[tuple(row.window.encode().split(b" "))].append(row.item_id)
        count += 1
        if count == block_windows:
            yield dict(block)
            block, count = defaultdict(list), 0
    yield dict(block)


def _scan(tables):
    kind = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))])

    @arrow_udf("struct<n_words:bigint,starts:array<int>,ends:array<int>,items:array<bigint>>")
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        search = tables.value.search
        out = []
        for text, prior in zip(texts.to_pylist(), before.to_pylist()):
            words = words_of(text)
            spans = list(zip(prior["starts"], prior["ends"])) if prior else []
            items = set(prior["items"]) if prior else set()
            for start, end, of in search(words):
                spans.append((start, end))
                items.update(of)
            merged: list[list[int]] = []
            for start, end in sorted(spans):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            out.append({"n_words": len(words), "starts": [s for s, _ in merged], "ends": [e for _, e in merged], "items": sorted(items)})
        return pa.array(out, kind)

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """All rows and columns of ``docs`` plus ``contamination``:
    ``struct<n_words, starts, ends, items>``, the hit word ranges (joined, end
    exclusive) and the ids of the items with windows in the text, ascending.

    Edge cases: a null or empty text has no words. An item without words or
    without id is no pattern; equal items are all reported. An empty benchmark
    finds nothing. Extra columns pass through; one called ``contamination`` is
    replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("contamination")
    found = fresh("found", docs)
    nothing = F.lit(None).cast("struct<n_words:bigint,starts:array<int>,ends:array<int>,items:array<bigint>>")
    out = docs.withColumn(found, nothing)
    for block in _blocks(windows_of(benchmark, window), block_windows):
        scan = _scan(spark.sparkContext.broadcast(WuManber(block)))
        out = out.withColumn(found, scan(text_bytes(), F.col(found)))
    return out.withColumnRenamed(found, "contamination")


def contamination_digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns, from the result of ``find_contamination``."""
    hits = F.aggregate(
        F.zip_with("contamination.starts", "contamination.ends", lambda s, e: (e - s).cast("long")),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    ids = F.array_sort(F.transform("contamination.items", lambda i: i.cast("string")))
    return scanned.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )
