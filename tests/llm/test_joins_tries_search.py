"""Operators 11 to 13 against brute force on edge rows, their bounds, and their SQL."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelmart.llm import common, lexical, near_dedup, partenum, prefix_trie, queries
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.oracle import compare


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- 11: n-gram Jaccard join ----------------------------------------------------------


def _varied(base: list, k: int, edits: int) -> str:
    rng, w = random.Random(k), list(base)
    for _ in range(rng.randint(0, edits)):
        w[rng.randrange(len(w))] = f"other{rng.randrange(30)}"
    return " ".join(w)


BASE = [f"word{i}" for i in range(150)]
PASSAGE = [f"shared{i}" for i in range(60)]
DOCS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "two words"), (5, "TWO  words"), (6, "one two three"), (6, "one two three"), (6, "another text of six"),
    (None, "one two three"), (None, "null id only"), (7, "x" * 100_000), (8, " ".join(f"long{i}" for i in range(30_000))),
    (9, " ".join(f"long{i}" for i in range(29_000))), (10, " ".join(f"long{i}" for i in range(20_000))), (11, "日本語 テキスト 👍 a b c d"),
    *[(100 + k, _varied(BASE, k, 5)) for k in range(60)],
    # alike but unlinked: one passage, ends of their own
    *[(200 + k, " ".join(PASSAGE + [f"end{k}-{i}" for i in range(9)])) for k in range(40)],
    # short sets around the sizes at which one differing element starts to count
    *[(300 + k, " ".join(f"s{i}" for i in range(n))) for k, n in enumerate(range(3, 33))],
    *[(None, _varied(PASSAGE, k, 2)) for k in range(20)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, i, "x", [1], "y") for i, (d, t) in enumerate(DOCS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, node string, signature array<int>, component string")


def exchanges(df) -> int:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text.count("Arguments: hashpartitioning")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_shared_signatures_and_buckets_cross_one_shuffle(spark, docs, monkeypatch, broadcast):
    rows = [(k % 7, k % 40, k % 3) for k in range(400)] + [(k, 1000 + k, 0) for k in range(30)] + [(5, 2000, 0)] * 3
    signs = spark.createDataFrame(rows, "short long, signature long, band int")
    want = sorted((s, g) for s, g, _ in rows if len({x for x, y, _ in rows if y == g}) > 1)
    got = partenum._shared(signs.select("short", "signature"))
    assert rows_of(got, "short", "signature") == sorted(want, key=str) and exchanges(got) == 1
    buckets = signs.selectExpr("short AS node", "band", "signature AS bucket").distinct()
    held = near_dedup._shared(buckets.localCheckpoint())
    keys = {(s, b, g) for s, g, b in rows}
    assert rows_of(held, "node", "band", "bucket") == sorted((k for k in keys if sum(k[2] == o[2] for o in keys) > 1), key=str)
    assert exchanges(held) == 1
    # The operators take them, and look nothing up again, whatever size Spark would send to all tasks.
    names, old = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for module, run in ((partenum, partenum.jaccard_components), (near_dedup, near_dedup.near_duplicates)):
            kept = module.stored
            monkeypatch.setattr(module, "stored", lambda df, name, kept=kept: names.append(name) or kept(df, name))
            run(docs.where("doc_id < 9"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert names.count("shared") >= 2 and "crowded" not in names


def test_jaccard_components(docs, monkeypatch):
    want = sorted(brute.jaccard_components(DOCS), key=str)
    got = lambda: rows_of(partenum.jaccard_components(docs), "doc_id", "n_shingles", "component_id")
    assert got() == want
    monkeypatch.setattr(partenum, "STARS", 0)  # blocks alone, several of them
    monkeypatch.setattr(partenum, "BLOCK", 4)
    assert got() == want
    assert partenum.jaccard_components(docs.where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32), st.sampled_from([75, 90, 95]))
def test_linked_sets_share_a_signature(common, a, b, seed, percent):
    values = np.random.default_rng(seed).integers(0, 2**63, common + a + b, np.uint64)
    left, right = np.unique(values[: common + a]), np.unique(np.concatenate((values[:common], values[common + a :])))
    if partenum.linked(left, right, percent) and (a or b):
        assert len(np.intersect1d(partenum.signatures(left, percent), partenum.signatures(right, percent)))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 300), st.integers(0, 300), st.integers(0, 2**32), st.sampled_from([75, 90]))
def test_sketches_of_linked_sets_are_near(common, a, b, seed, percent):
    values = np.random.default_rng(seed).integers(0, 2**63, common + a + b, np.uint64)
    left, right = np.unique(values[: common + a]), np.unique(np.concatenate((values[:common], values[common + a :])))
    if partenum.linked(left, right, percent):
        assert partenum.near(partenum.sketch(left), partenum.sketch(right), np.array(len(left)), np.array(len(right)), percent)


def test_bands_hold_every_linked_size():
    for percent in (75, 90):
        for size in range(1, 2000):
            smallest = -(-percent * size // 100)
            assert partenum.band_of(size, percent)[0] - partenum.band_of(smallest, percent)[0] in (0, 1)


# --- 12: conversation prefix trie ------------------------------------------------------


def _conversations():
    rng, rows = random.Random(5), []
    for c in [*range(0, 330, 3), -7, -100, 100, 200, 10**12]:
        for t in range(rng.randint(1, 9)):
            # few texts, so that prefixes meet
            rows.append((c, t, ["user", "assistant"][t % 2], f"text {rng.randrange(2)} é👍" if t < 3 else f"{rng.randrange(4)}"))
    rows += [(400, None, None, None), (400, 1, "user", ""), (400, 1, "user", "tie"), (400, 1, "user", "tie"), (None, 1, "user", "nobody's"), (500, 3, "a:b", "c"),
             (501, 3, "a", "b:c"), (77_777, 0, "user", "z" * 50_000)]
    rows += [(600, t, "user", str(t)) for t in range(400)] + rows[:5]
    return rows


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("hot, piece", [(prefix_trie.HOT, prefix_trie.PIECE), (3, 2)])
def test_prefix_trie(spark, monkeypatch, hot, piece):
    rows = _conversations()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, high string")
    want = sorted(brute.prefix_trie(rows), key=str)
    # The pieces of end lists are cut in Python workers, which read the module anew: only the broadcast's share is patched there.
    monkeypatch.setattr(prefix_trie, "HOT", hot)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    assert rows_of(prefix_trie.prefix_trie(table), *COLUMNS) == want
    assert prefix_trie.prefix_trie(table.where("false")).count() == 0


def test_end_lists_in_pieces(monkeypatch):
    import hashlib

    import pyarrow as pa

    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    ids = list(range(10))
    batch = pa.RecordBatch.from_pydict({"high": [1] * 10, "low": [2] * 10, "depth": [3] * 10, "conv_id": ids})
    pieces = [p for p in prefix_trie._joined_ids(iter([batch.slice(0, 4), batch.slice(4)])) if p.num_rows]
    assert sum(p.num_rows for p in pieces) == 4
    out = [r for p in prefix_trie._digests(iter(pieces)) for r in p.to_pylist()]
    assert out == [{"high": 1, "low": 2, "depth": 3, "ends_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}]


# --- 13: ranked lexical search ---------------------------------------------------------


def _search_docs():
    rng, words = random.Random(9), [f"w{i}" for i in range(40)] + ["Été", "été", "日本"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for k in range(120)]
    rows += [(1000 + k, "w1 w2, w3") for k in range(70)] + [(2000, "W1-w2.w3")] * 3 + [(None, "w1 w2 w3"), (None, "w4")]
    return rows + [(3000, None), (3001, ""), (3002, ".,;"), (3003, "w5 " * 60_000), (3004, "x" * 100_000)]


SEARCH = [(1, "w1 w2 W1"), (2, "été w7 w8 w9"), (2, "w10"), (3, None), (4, ""), (5, "unseen"), (None, "w4 w5"), (6, " ".join(f"w{i}" for i in range(40)))]


@pytest.mark.parametrize("k, block", [(50, lexical.BLOCK), (3, 4)])
def test_ranked_search(spark, k, block):
    rows = _search_docs()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, m int, terms string")
    items = spark.createDataFrame([(*r, 1) for r in SEARCH], "item_id long, text string, rank int")
    out = lexical.rank_documents(docs, items, k=k, block=block)
    assert rows_of(out, "item_id", "rank", "doc_id", "score") == sorted(brute.ranked(rows, SEARCH, k), key=str)
    assert lexical.rank_documents(docs.where("false"), items, k=k).count() == 0
    assert lexical.rank_documents(docs, items.where("false"), k=k).count() == 0


def test_scores_in_pieces(monkeypatch):
    postings = lexical.Postings(3, np.array([0, 2, 3]), np.array([0, 2, 1]), np.array([7, 5]))
    whole = postings.scores(np.array([100, 60]), np.array([0, 0, 1]), np.array([0, 1, 0]), np.array([1, 4, 2]))
    monkeypatch.setattr(lexical, "EXPANDED", 1)
    assert (whole == postings.scores(np.array([100, 60]), np.array([0, 0, 1]), np.array([0, 1, 0]), np.array([1, 4, 2]))).all()
    assert whole.tolist() == [[7 * (10**9 // 3000), 5 * (4 * 10**9 // 6000), 7 * (10**9 // 3000)], [7 * (2 * 10**9 // 3200), 0, 7 * (2 * 10**9 // 3200)]]


@pytest.mark.parametrize("name", ["op11_partenum_join", "op12_prefix_trie", "op13_bag_search"])
def test_query_matches_its_sql(spark, duck_small, name):
    r = compare(queries.QUERIES[name](spark, SF_SMALL), queries.ORACLE[name], duck_small)
    assert r["schema_match"] and r["rows_match"] and r["hash_match"], r


def test_texts_are_filtered_before_their_shuffle(spark, docs, monkeypatch):
    """Few of the texts are wanted: Spark gets a filter for them, and repeated rows need no shuffle of their own."""
    plans = []
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", **{k: spark.conf.get(k) for k in common.FILTERED_JOINS}}
    monkeypatch.setitem(common.FILTERED_JOINS, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    written = common.stored(docs.select("doc_id", "text"), "texts")
    for module, run in ((partenum, partenum.jaccard_components), (near_dedup, near_dedup.near_duplicates)):
        def kept(df, name):
            if name == "sets":
                plans.append((df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"), exchanges(df)))
            return common.stored(df, name)

        want = rows_of(run(docs), "doc_id", "component_id")
        monkeypatch.setattr(module, "stored", kept)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert rows_of(run(written), "doc_id", "component_id") == want
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(plans) == 2 and all("might_contain" in plan for plan, _ in plans)
    assert all(n == 2 for _, n in plans)
    assert all(spark.conf.get(k) == v for k, v in settings.items() if k in common.FILTERED_JOINS)


def test_equal_groups_leave_one(spark):
    """Of signatures or buckets held by the same nodes one stays, and every group of nodes with it."""
    rows = [(n, 100 * k + g) for g, nodes in enumerate(([1, 2], [1, 2, 3], [4, 5])) for k in range(5) for n in nodes] + [(1, 0)] * 2
    signs = spark.createDataFrame(rows, "short long, signature long")
    got = rows_of(partenum._representative(partenum._shared(signs)), "short", "signature")
    assert got == sorted([(1, 0), (2, 0), (1, 1), (2, 1), (3, 1), (4, 2), (5, 2)], key=str)
    spread = spark.createDataFrame([(2, 7, 8, 3, 30, "a"), (2, 7, 8, 1, 40, "a"), (2, 9, 8, 5, 50, "b")], "held int, x long, y long, band int, bucket long, centre string")
    assert rows_of(near_dedup._one_of_equal(spread), "bucket", "centre") == sorted([(40, "a"), (50, "b")], key=str)


def test_large_tables_go_when_nothing_reads_them(docs, monkeypatch):
    """Band keys are freed, signatures never written."""
    tables = {}
    for module, run in ((partenum, partenum.jaccard_components), (near_dedup, near_dedup.near_duplicates)):
        def kept(df, name, module=module):
            tables[module, name] = common.stored(df, name)
            return tables[module, name]

        monkeypatch.setattr(module, "stored", kept)
        run(docs).collect()
    assert not any("signatures" in df.columns for df in tables.values())
    there = lambda df: os.path.exists(df.stored_at.removeprefix("file://"))
    assert not there(tables[near_dedup, "signed"]) and not there(tables[near_dedup, "nodes"]) and there(tables[near_dedup, "members"])
