"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Exact comparison: same column names, same row count, same multiset of rows
after normalising values to text (floats by ``repr``, so a last-bit difference
fails). Used by the tests and by ``python -m tests.oracle <sf_dir> [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import sys

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone = 'UTC'")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{norm(k)}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return names, out


def compare(spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_names, s_vals = canon(s_cols, s_rows)
    d_names, d_vals = canon(d_cols, d_rows)
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "schema_match": s_names == d_names,
        "rows_match": len(s_rows) == len(d_rows),
        "hash_match": hashlib.sha256("\n".join(s_vals).encode()).hexdigest()
        == hashlib.sha256("\n".join(d_vals).encode()).hexdigest(),
    }
    if not out["schema_match"]:
        out["cols_spark"], out["cols_oracle"] = s_names, d_names
    if not out["hash_match"]:
        sd, dd = set(s_vals), set(d_vals)
        out["only_spark"] = sorted(sd - dd)[:3]
        out["only_oracle"] = sorted(dd - sd)[:3]
    return out


def main(argv):
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from parcelmart.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(E.queries())
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names:
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                r = compare(df, sqls[name], con)
                ok = r["schema_match"] and r["rows_match"] and r["hash_match"]
            else:
                r = {"rows_spark": df.count(), "oracle": "none"}
                ok = True
        except Exception as e:  # noqa: BLE001
            r, ok = {"error": repr(e)[:600]}, False
        bad += not ok
        print(("OK  " if ok else "BAD ") + name, r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
