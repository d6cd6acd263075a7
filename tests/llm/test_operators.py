"""Every corpus operator against brute force on edge rows: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import base64
import random
import re
import struct
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelmart.llm import cotrain, decontaminate, histogram_sort, licenses, line_dedup, near_dedup, pfor, queries, secrets, topk_search
from parcelmart.llm.bpe import BytePairCodec, bpe_decode, bpe_encode, codec
from parcelmart.llm.license_texts import TEMPLATES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.oracle import compare

LONG = "the Long line that five documents and more hold, with Ümläute and CAPITALS"
BASE = " ".join(f"word{i}" for i in range(120))


def _near(k: int) -> str:
    rng, w = random.Random(k), BASE.split()
    for _ in range(rng.randint(0, 4)):
        w[rng.randrange(len(w))] = f"other{rng.randrange(9)}"
    return " ".join(w)


DOCS = [
    (1, "alpha\n" + LONG), (2, LONG.lower() + "\n beta"), (3, "  " + LONG + "\t\r"), (4, LONG + "\n" + LONG), (5, "gamma\n\n" + LONG),
    (5, "gamma\n\n" + LONG),  # a repeated row
    (6, None), (7, ""), (8, " \n\t "), (None, LONG), (None, "null id"), (9, "few words"), (10, "FEW  words"), (11, "one two three four five six"),
    (12, "é" * 40), (13, "Password: hunter22 AKIA" + "Q7" * 9 + " x" + "0a" * 20), (13, "same id, other text"),
    (14, "x" * 200_000 + " " + " ".join(str(i) for i in range(3000))), (15, "日本語 テキスト 👍 a  b c \n\n d"),
    *[(100 + k, _near(k)) for k in range(40)],
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None if i % 7 == 0 else "en", f"src{i % 3}", None if i % 5 == 0 else len(t or ""), i, "x", True) for i, (d, t) in enumerate(DOCS)]
    return spark.createDataFrame(rows, SCHEMA + ", lang string, source string, n_chars long, n_lines int, size string, kept boolean")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_line_dedup(docs, empty):
    out = line_dedup.dedup_lines(docs)
    assert set(out.columns) == set(docs.columns) | {"n_dropped"}
    assert rows_of(out, "doc_id", "n_lines", "n_dropped", "text") == sorted(brute.line_dedup(DOCS), key=str)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_near_duplicates(docs, empty, monkeypatch):
    want = sorted(brute.near_duplicates(DOCS), key=str)
    assert rows_of(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    monkeypatch.setattr(near_dedup, "BLOCK", 8)  # a bucket in several blocks
    assert rows_of(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_without_ids(spark):
    """Rows without an id fetch their own texts; 1,500 near copies fill several blocks and end as one component."""
    base = " ".join(f"w{i}" for i in range(60))
    near = spark.range(1500).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit(base + " x"), F.col("id").cast("string")).alias("text"))
    out = near_dedup.near_duplicates(near.union(spark.createDataFrame([(5, base + " y")], SCHEMA)))
    assert [tuple(r) for r in out.groupBy("component_id", "n_shingles").count().collect()] == [(5, 57, 1501)]


def test_min_max_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:800], rng.integers(0, 2**63, 200, dtype=np.uint64))))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    (la, ha), (lb, hb) = near_dedup.min_max_signature(a), near_dedup.min_max_signature(b)
    assert abs(np.concatenate((la == lb, ha == hb)).mean() - true) < 0.08


ITEMS = [
    (1, "word0 word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11"), (2, "FEW words"), (3, "few words"), (4, None), (5, " . "),
    (None, "gamma"), (6, "word4 word5 word6 word7 word8 word9 word10 word11 word12 word13"), (7, "日本語 テキスト"), (8, "beta"),
]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 2])
def test_decontamination(spark, docs, empty, block):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, contamination int")
    out = decontaminate.find_contamination(docs, items, block_windows=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in decontaminate.contamination_digest(out).collect()), key=str)
    want = [(d, n, h, brute.sha(",".join(ids)), h > 0) for d, n, h, ids in brute.contamination(DOCS, ITEMS)]
    assert got == sorted(want, key=str)
    assert decontaminate.find_contamination(empty, items).count() == 0
    clean = decontaminate.find_contamination(docs, items.where("false"))
    assert clean.where(F.size("contamination.items") > 0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), max_size=6))
def test_wu_manber_finds_every_occurrence(text, patterns):
    text, patterns = [t.encode() for t in text], {tuple(w.encode() for w in p): [i] for i, p in enumerate(patterns)}
    got = {(a, b) for a, b, _ in decontaminate.WuManber(patterns).search(text)}
    assert got == {(i, i + len(p)) for p in patterns for i in range(len(text)) if tuple(text[i : i + len(p)]) == p}


def test_histogram_sort(spark, docs, empty):
    out = histogram_sort.shard_by_bytes(docs, n_shards=5)
    got = out.select("doc_id", "text", "size", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(DOCS)
    assert all(r.size == len((r.text or "").encode()) + 8 for r in got)
    for shard in {r.shard for r in got}:
        mine = sorted(r.slot for r in got if r.shard == shard)
        assert mine == list(range(len(mine))) and 0 <= shard < 5
    assert histogram_sort.shard_by_bytes(empty).count() == 0


def test_histogram_sort_balances_a_hot_text(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, F.lit("copy " * 20)).otherwise(F.col("id").cast("string")).alias("text"))
    sizes = [r.b for r in histogram_sort.shard_by_bytes(hot, n_shards=8, tolerance=0.01).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.03 * sum(sizes) / 8 + 108
    small = histogram_sort.shard_by_bytes(hot.where("doc_id >= 1490"), n_shards=4)
    assert small.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 2").count() == 0


def test_histogram_sort_query_moves_the_texts(spark):
    out = queries.op2_histogram_sort(spark, SF_SMALL)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("crc32") < plan.index("Window")  # above the exchange that the window needs
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.size, r.text_crc32) for r in out.collect()}
    assert got == {d: (len(t) + 8, zlib.crc32(t)) for d, t in texts.items()}


NOTICE = "Licensed under the Apache License, Version 2.0"
MIT = TEMPLATES["mit-text"]


def test_license_scan(spark, empty):
    edited = MIT.replace("limitation", "restraint").replace("sublicense", "lend")
    texts = [(1, "intro " * 30 + NOTICE + " outro" * 20), (2, NOTICE), (3, "the apache licence plate of version 2"), (4, None), (5, ""), (6, "x " * 5000 + MIT + " y" * 500),
             (7, edited), (None, TEMPLATES["cc-by-nc-4.0"]), (2, NOTICE), (8, " ".join(MIT.split()[:20]))]
    out = licenses.scan_licenses(spark.createDataFrame([(d, t, "z") for d, t in texts], SCHEMA + ", license_id string"), TEMPLATES)
    got = {(r.doc_id, r.license_id): r.containment for r in out.collect()}
    assert set(got) == {(1, "apache-2.0"), (2, "apache-2.0"), (6, "mit-text"), (7, "mit-text"), (None, "cc-by-nc-4.0")}
    assert got[1, "apache-2.0"] == got[6, "mit-text"] == 1 and 0.8 <= got[7, "mit-text"] < 1
    assert licenses.scan_licenses(empty, TEMPLATES).count() == 0


GPL, LGPL, AGPL = (TEMPLATES[k] for k in ("gpl-notice", "lgpl-notice", "agpl-notice"))


def test_license_siblings_are_told_apart(spark):
    """Every template alone gives itself; siblings without a template give none; two notices give both."""
    lgpl = GPL.replace("GNU General", "GNU Lesser General")
    work, cc = TEMPLATES["gpl-3.0"], TEMPLATES["cc-by-4.0"]
    rest = (" either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, "
            "but WITHOUT ANY WARRANTY. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along")
    texts = {k: (v, {k}) for k, v in TEMPLATES.items()} | {
        "lgpl program": (lgpl, {"lgpl-notice"}), "library": (GPL.replace("GNU General", "GNU Library General"), set()),
        "lgpl naming gpl": (lgpl + rest, {"lgpl-notice"}), "agpl naming gpl": (AGPL + rest, {"agpl-notice"}), "gpl": (GPL + rest, {"gpl-notice"}),
        "both": (GPL + " or, as you like, " + AGPL, {"gpl-notice", "agpl-notice"}),
        "worded": (GPL.replace("terms of", "terms of version 3 of"), {"gpl-notice"}),
        "gpl 1": (work.replace("3.", "1."), set()), "library 3": (work.replace("GNU", "GNU Library"), set()),
        "cc 3": (cc.replace("4.0", "3.0"), set()), "both cc": (cc + ". " + TEMPLATES["cc-by-sa-4.0"], {"cc-by-4.0", "cc-by-sa-4.0"}),
    }
    names, around = list(texts), "some words of the page "
    rows = [(i, around * 30 + texts[n][0] + " " + around * 30) for i, n in enumerate(names)]
    out = {n: set() for n in names}
    for r in licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA), TEMPLATES).collect():
        out[names[r.doc_id]].add(r.license_id)
    assert out == {n: want for n, (_, want) in texts.items()}


def test_license_shingles_hold_key_words():
    keys = set(licenses.key_words(TEMPLATES))
    for text in TEMPLATES.values():
        w = licenses._words(text)
        for i in range(len(w) - 2):
            assert set(w[i : i + 3]) & keys or set(w[i : i + 3]) <= licenses.COMMON


def test_secrets(spark, docs, empty):
    model = secrets.train(secrets.labelled_samples(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/pages.parquet")))
    out = secrets.secret_digest(secrets.scan_secrets(docs, model)).collect()
    want = sorted((str(d), brute.sha(brute.base_secrets(t))) for d, t in DOCS)
    assert sorted((str(r.doc_id), r.base_sha256) for r in out) == want
    assert secrets.secret_digest(secrets.scan_secrets(empty, model)).count() == 0
    key = base64.b64encode(bytes(random.Random(5).randbytes(30))).decode()
    found = spark.createDataFrame([(1, f"é the {key} of thingthionerstionthe ordinary_identifier_name 4111111111111111")], SCHEMA)
    assert secrets.secret_digest(secrets.scan_secrets(found, model)).first().spans == f"markov:6:{6 + len(key)}"
    # Held out: random strings of another seed, and identifiers.
    rng = random.Random(9)
    strange = [base64.b64encode(rng.randbytes(24)).decode() for _ in range(100)]
    plain = ["customer_order_history_table", "getUserAccountBalance", "international-shipping-address", "20240131120000123456"] * 10
    judged = spark.createDataFrame([(t, 1) for t in strange] + [(t, 0) for t in plain], "token string, y int")
    hits = judged.select("y", (secrets.ratio(F.col("token"), model) > secrets.MARGIN).alias("hit")).collect()
    assert sum(r.hit for r in hits if r.y) >= 97 and not any(r.hit for r in hits if not r.y)


def test_spans_of_very_many_matches(spark):
    """Blocks of folded positions: 3,000 runs of two kinds in one text, some inside base spans, against a plain scan."""
    rng, even = random.Random(7), [0.5] * (secrets.STATES**2)
    words = [f"é {rng.getrandbits(120):030x}" if i % 3 else f"{rng.getrandbits(120):030X}" for i in range(3000)]
    text = " ".join(words)
    row = secrets.scan_secrets(spark.createDataFrame([(1, text)], SCHEMA), even, margin=0.0).first()
    hexes = [(m.start(), 2, m.end(), m.group()) for m in re.finditer(r"[0-9a-f]{24,}", text)]
    runs = [(m.start(), 3, m.end(), m.group()) for m in re.finditer(secrets.RUN, text)]
    touched = lambda r: any(s < r[2] and r[0] < e for s, _, e, _ in hexes)
    assert [tuple(s) for s in row.base] == hexes
    assert [tuple(s) for s in row.markov] == [r for r in runs if not touched(r)]


def test_identifier_model_counts_all_rows(spark):
    """Identifiers of a source with few of many rows are known, wherever the hashes of their ids lie."""
    common = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("ordinary words of the usual kind").alias("text"))
    rare = spark.range(6000, 6300).select(F.col("id").alias("doc_id"), F.lit("ZxqVwkJyzXqv").alias("text"))
    samples = secrets.labelled_samples(common.union(rare))
    counted = {r.token: r["count"] for r in samples.where("random = 0 AND token IN ('ordinary', 'ZxqVwkJyzXqv')").groupBy("token").count().collect()}
    assert counted == {"ordinary": 6000, "ZxqVwkJyzXqv": 300}
    pages = spark.range(5000).select(F.col("id").alias("page_id"), F.lit("https://host/ZxqVwk").alias("url"))
    assert secrets.labelled_samples(common, pages).where("token LIKE '%/ZxqVwk'").count() == 5000


def test_transition_ratios_equal_plain_counts(spark):
    from math import log

    tokens = [("abca", 0), ("a-é👍b", 0), ("zz9=", 1), ("abZ", 1), ("x", 1), (None, 0)]
    place, counts = lambda c: secrets.ALPHABET.find(c) + 1, Counter()
    for t, y in tokens:
        counts.update((y, place(a), place(b)) for a, b in zip(t or "", (t or "")[1:]))
    n = secrets.STATES
    sums = {(y, a): sum(counts[y, a, b] for b in range(n)) for y in (0, 1) for a in range(n)}
    chance = lambda y, a, b: (counts[y, a, b] + 0.5) / (sums[y, a] + 0.5 * n)
    want = [log(chance(1, a, b) / chance(0, a, b)) for a in range(n) for b in range(n)]
    assert secrets.train(spark.createDataFrame(tokens, "token string, random int")) == pytest.approx(want)


VECTORS = [(i, [float(x) for x in np.random.default_rng(i).normal(0, 0.2, 8)]) for i in range(230)]
VECTORS += [(50, VECTORS[50][1]), (300, [0.5] * 8), (301, [0.5] * 8), (302, [0.5] * 8), (350, None), (351, [float("nan")] * 8), (352, [None] + [0.1] * 7),
            (400, [float("inf")] * 8), (None, [0.1] * 8), (450, []), (500, [1e30] * 8), (501, [0.25, -0.25])]


def test_block_search(spark):
    frame = spark.createDataFrame([(i, v, 3, 1) for i, v in VECTORS], "vec_id long, embedding array<double>, label int, rank int")
    vectors = topk_search.quantised(frame)
    usable = [(i, v) for i, v in VECTORS if i != 500]
    out = topk_search.top_k(vectors.where("vec_id % 50 = 0 AND vec_id <> 500"), vectors.where("vec_id <> 500"), block=16, group=2, query_group=3)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in out.collect()} == brute.top_k(usable)
    large = topk_search.top_k(vectors.where("vec_id = 500"), vectors)  # products beyond the long range
    assert large.count() == 5 and large.first().rank == 1
    assert topk_search.top_k(vectors.where("false"), vectors).count() == 0
    two = vectors.where("vec_id IN (300, 301)")
    assert [tuple(r) for r in topk_search.top_k(two.where("vec_id = 300"), two).collect()] == [(300, 1, 301, 8 * 128 * 128)]


def test_block_search_query_keeps_repeated_rows(spark, tmp_path):
    import duckdb

    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(0, 0.2, 8)]) for i in range(120)]
    rows += [rows[i] for i in (0, 3, 3, 7, 50, 50, 90)] + [(400, [0.9] * 8)] * 4
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    sql = f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'"
    with duckdb.connect() as duck:
        duck.execute(sql)
        want = duck.execute(queries.ORACLE["op6_block_search"]).fetchall()
    got = [tuple(r) for r in queries.op6_block_search(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted(want) and len({r[2] for r in got if r[0] == 100}) < 5


@cache
def _library():
    import tiktoken

    with open(queries.BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, empty):
    library = _library()
    got = rows_of(queries.bpe_digest(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for d, t in DOCS:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha(t or "")))
    assert got == sorted(want, key=str)
    assert queries.bpe_digest(empty).count() == 0
    ids = docs.select("doc_id", bpe_encode("text", queries.BPE_RANKS, P.PATTERN).alias("ids"))
    texts = ids.select("doc_id", bpe_decode("ids", queries.BPE_RANKS, P.PATTERN).cast("string").alias("text"))
    assert rows_of(texts, "doc_id", "text") == sorted(((d, t or "") for d, t in DOCS), key=str)


ODD = ["a", "b", "é", "ß", " ", "  ", "\n", "\n\n", "\r", "\t", "1", "中", "👍", "_", "-", "the", "'s", "ing", " ", " ", "\x1c", "\x85", "<|endoftext|>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=40).map("".join))
def test_encoders_equal_their_libraries(text):
    own, library = codec(queries.BPE_RANKS, P.PATTERN), _library()
    ids = library.encode_ordinary(text)
    encoded = own.encode([text])[0]
    assert encoded == struct.pack(f"<{len(ids)}I", *ids) and own.decode(encoded) == text.encode()
    other = pfor.library_encoder(queries.LIBRARY_FILE, P.PATTERN)
    ids = other.library.encode(text, add_special_tokens=False).ids
    assert other.encode([text])[0] == struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=20).map("".join), max_size=4))
def test_token_encoder_equals_the_library_as_loaded(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.LIBRARY_FILE)
    texts = [*texts, "a <|endoftext|> b", "a b"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[-2] == [64, 220, 50256, 275]
    got = pfor.library_encoder(queries.LIBRARY_FILE, P.PATTERN).encode(texts)
    assert got == [struct.pack(f"<{len(ids)}I", *ids) for ids in want]


def test_chunk_table_keeps_results_when_it_is_full():
    from parcelmart.llm.chunks import ChunkTable

    table = ChunkTable(lambda t: t.encode(), lambda chunks: [c.encode() for c in chunks], limit=3)
    for text in ["a b c d", "a b\nc  d e", "b c d\ne f", "", " lead", "trail ", "a b c d"] * 3:
        assert table.encode([text, "x y"]) == [text.encode(), b"x y"]


def test_chunk_table_is_asked_once_for_a_repeated_chunk(monkeypatch):
    from parcelmart.llm import chunks

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    table = chunks.ChunkTable(lambda t: t.encode(), lambda keys: [k.encode() for k in keys])
    table.table = Counted()
    texts = ["a b c b\nc b c", "", "b c", "a  b", "é b é\n", "c"] * 50
    assert table.encode(texts) == [t.encode() for t in texts]
    assert Counted.asked <= 6  # b, c, a line break and c, an empty one, é, a line break alone
    monkeypatch.setattr(chunks, "RUN", 1)  # every text by itself
    assert table.encode(texts) == [t.encode() for t in texts] and table.encode([]) == []


def test_chunk_tables_stay_near_their_limit(monkeypatch):
    """Also within one batch; and the byte-level tables, which stay in workers that later steps use, are the smaller ones."""
    from parcelmart.llm import chunks

    monkeypatch.setattr(chunks, "RUN", 100)
    table = chunks.ChunkTable(lambda t: t.encode(), lambda keys: [k.encode() for k in keys], limit=50)
    texts = [" ".join(f"w{10 * i + k}" for k in range(10)) for i in range(200)]
    assert table.encode(texts) == [t.encode() for t in texts]
    assert len(table.table) + len(table.older) <= 2 * (50 + 100)
    codec = BytePairCodec({bytes([b]): b for b in range(256)}, P.PATTERN)
    assert codec.chunks.limit <= 200_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(-(2**63), 2**63 - 1)), max_size=300), st.sampled_from([8, 64, 1024]))
def test_packed_stream_round_trip(values, block):
    values = np.array(values, np.int64)
    stream = pfor.Stream(memoryview(pfor.pack(values, block)), block)
    assert (stream.all() == values).all() and len(stream.all()) == len(values)
    for k in range(stream.blocks):
        assert (stream.read(k) == values[k * block : (k + 1) * block]).all()


def test_token_files(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.LIBRARY_FILE)
    files = pfor.write_token_files(docs, queries.LIBRARY_FILE, P.PATTERN, end_id=2, file_ids=50, block=16)
    want, start = [], 0
    for d, t in sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert files.count() > 5
    assert rows_of(pfor.read_token_files(files), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    none = pfor.write_token_files(empty, queries.LIBRARY_FILE, P.PATTERN, end_id=2)
    assert none.count() == 0 and pfor.read_token_files(none).count() == 0


def test_co_training_sums_all_unlabelled_rows(spark):
    """The sums over the tasks equal those over all rows at once, and a source outside any sample has its place."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "of", "zz9", "Q"]) for _ in range(20)), "en", "rare" if i % 50 == 0 else f"s{i % 3}", 60) for i in range(900)]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string, source string, n_chars long").repartition(7)
    places = cotrain.metadata_places(docs)
    assert set(places[1]) == {"rare", "s0", "s1", "s2"} and sorted(p for of in places for p in of.values()) == list(range(3, 9))
    size = 9
    pool = docs.select(cotrain._text_vector()(cotrain.text_bytes()).alias("x"), cotrain._place_keys(places)(*cotrain.metadata_values(docs)).alias("keys"))
    gen = np.random.default_rng(2)
    labellers, now = ([gen.normal(0, 1, n) for n in (cotrain.TEXT_DIM + 1, size + 1)] for _ in range(2))
    got = cotrain._summed(pool, size)(labellers, now, (0.4, 0.6))
    all_rows = pool.collect()
    text, meta = cotrain._matrices([bytes(r.x) for r in all_rows], [bytes(r["keys"]) for r in all_rows], size)
    want = cotrain.pseudo_sums(cotrain._design(text), cotrain._design(meta), labellers, now, (0.4, 0.6))
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-3, atol=1e-3)


def test_co_training(spark, docs, empty):
    sf_dir = "/root/testdata/sf0.1"
    all_docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    model = cotrain.train(all_docs, seen)
    scored = cotrain.score(all_docs, model)
    judged = scored.join(held, "doc_id").select("quality", "accepted", "quality_score").collect()
    good, bad = [r.accepted for r in judged if r.quality], [r.accepted for r in judged if not r.quality]
    print("accepted of good, of bad:", sum(good), len(good), sum(bad), len(bad))
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.1 * len(bad)
    assert scored.count() == all_docs.count()
    out = cotrain.score(docs.withColumn("accepted", F.lit(3)), model)
    assert out.count() == len(DOCS) and out.where("quality_score IS NULL OR quality_score < 0 OR quality_score > 1").count() == 0
    assert cotrain.score(empty, model).count() == 0
    assert cotrain.train(empty, labels) is None and cotrain.train(all_docs, labels.where("quality = 1")) is None
    assert cotrain.score(docs, None).where("accepted").count() == len(DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck_small, name):
    r = compare(queries.QUERIES[name](spark, SF_SMALL), queries.ORACLE[name], duck_small)
    assert r["schema_match"] and r["rows_match"] and r["hash_match"], r
