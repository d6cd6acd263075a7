"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.bpe import bpe_round_trip
from parcelmart.llm.common import small_batches, stored, table
from parcelmart.llm.cotrain import score, train as train_quality
from parcelmart.llm.decontaminate import contamination_digest, find_contamination
from parcelmart.llm.histogram_sort import byte_size, shard_by_bytes
from parcelmart.llm.lexical import rank_documents
from parcelmart.llm.license_texts import TEMPLATES
from parcelmart.llm.licenses import scan_licenses
from parcelmart.llm.line_dedup import dedup_lines
from parcelmart.llm.near_dedup import near_duplicates
from parcelmart.llm.partenum import jaccard_components
from parcelmart.llm.pfor import read_token_files, write_token_files
from parcelmart.llm.prefix_trie import prefix_trie
from parcelmart.llm.secrets import labelled_samples, scan_secrets, secret_digest, train
from parcelmart.llm.topk_search import quantised, top_k

#: Public vocabulary files; on a cluster the same paths must hold on every machine.
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY_FILE = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by co-trained text and metadata classifiers."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "text_score", "meta_score", "quality_score", "accepted")


def op2_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Size and digest are taken from the text that comes out of the exchange, so that the texts move.
    return shard_by_bytes(docs, n_shards=24, tolerance=0.01).select(
        "doc_id", byte_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 and more code points in 5 and more documents stay in one of them."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License templates found in the documents, by MinHash bands and exact containment."""
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), TEMPLATES)


def op5_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by fixed patterns and by Markov models of random strings and identifiers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(labelled_samples(docs, table(spark, sf_dir, "pages")))
    return secret_digest(scan_secrets(docs, model))


def op6_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every vector whose id is divisible by 50."""
    vectors = stored(quantised(table(spark, sf_dir, "embeddings"), scale=256, repeats=True), "vectors")
    return top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op7_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have similarity 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=75, size=5)


def bpe_digest(docs: DataFrame) -> DataFrame:
    """Encode every text, decode the ids again; counts and digests of both."""
    small_batches(docs.sparkSession)
    both = docs.select("doc_id", bpe_round_trip("text", BPE_RANKS, PATTERN).alias("r")).select("doc_id", "r.ids", "r.decoded")
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text and back."""
    return bpe_digest(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written to patched frame-of-reference files by ascending doc_id, and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_token_files(write_token_files(docs, LIBRARY_FILE, PATTERN, end_id=2))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of ``benchmark`` found in ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination_digest(find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10))


def op11_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have similarity 0.9 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), percent=90, size=3)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt ``conversations``."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best ``documents`` for each ``benchmark`` item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {f.__name__: f for f in (
    op1_co_training, op2_histogram_sort, op3_line_dedup, op4_license_scan, op5_markov_secrets, op6_block_search, op7_min_max_hash, op8_byte_bpe,
    op9_token_files, op10_decontaminate, op11_partenum_join, op12_prefix_trie, op13_bag_search,
)}

ORACLE: dict[str, str] = {}

ORACLE["op3_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, pos, string_split(coalesce(text, ''), chr(10))[pos] AS line
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents)
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), frequent AS (
    SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
    GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id < keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR doc_id >= keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (k)
GROUP BY doc_id
"""

ORACLE["op10_decontaminate"] = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM benchmark
), patterns AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS p
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)
), places AS (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM docs, (SELECT DISTINCT m FROM patterns) WHERE len(w) >= m
), found AS (
    SELECT doc_id, i, p.m AS m, item_id
    FROM (SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS p FROM places) d
    JOIN patterns p ON d.p = p.p AND d.m = p.m
), hit AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS spot FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op7_min_max_hash"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(node, root) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

ORACLE["op6_block_search"] = r"""
WITH v AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE["op11_partenum_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach(node, root) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

# crc32 is written out: each byte of the decimal id is folded in, then eight shifts.
ORACLE["op12_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           xor(list_reduce([4294967295] || [CAST(unicode(c) AS BIGINT) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')],
                           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                                         lambda v, z: xor(v >> 1, 3988292384 * (v & 1)) + z)), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), sequences AS (
    SELECT conv_id, coalesce(s, []) AS s
    FROM convs LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS s FROM rebuilt GROUP BY conv_id) USING (conv_id)
), nodes AS (
    SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           CASE WHEN depth = 0 THEN 0 ELSE length(p[depth].text) END AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(s) = depth), '')) AS ends_sha256
    FROM (SELECT conv_id, s, depth, s[1:depth] AS p FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM sequences))
    GROUP BY p, depth
), children AS (
    SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), whole AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (p, depth)
), below AS (
    SELECT p[1:above] AS p, above AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM whole) GROUP BY ALL
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM whole n JOIN below USING (p, depth) LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]
"""

ORACLE["op13_bag_search"] = r"""
WITH tokens AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t
    FROM documents
), counts AS (
    SELECT doc_id, t, count(*) AS tf FROM tokens GROUP BY doc_id, t
), lengths AS (
    SELECT doc_id, sum(tf) AS n FROM counts GROUP BY doc_id
), totals AS (
    SELECT count(*) AS n_docs, sum(n) AS len FROM lengths
), weights AS (
    SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, totals GROUP BY t, n_docs
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * CAST(50 + (50 * n * n_docs) // len AS BIGINT)))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (t) JOIN weights USING (t) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""
