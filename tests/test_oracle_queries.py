"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_query_has_an_oracle_or_is_listed():
    # Of the library's own queries only the random tokens have no SQL equivalent.
    own = {n for n in QUERIES if not n.startswith("op") and n != "pipeline"}
    assert own - set(ORACLE) == {"token_url"}


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not n.startswith("op")))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], duck_small)
    assert r["schema_match"], r
    assert r["rows_match"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "unique_bookings" in df.columns and len(df.columns) == 74
    assert df.count() > 0


def test_token_url_shape(spark):
    rows = QUERIES["token_url"](spark, SF_SMALL).collect()
    tokens = [r.url.rsplit("=", 1)[1] for r in rows]
    assert len(rows) == 150
    assert all(len(t) == 43 for t in tokens)
    assert len(set(tokens)) == len(tokens)
    assert all(set(t) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_") for t in tokens)
