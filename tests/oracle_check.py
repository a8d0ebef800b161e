"""Runs registered queries and their oracle SQL side by side.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return int(value)
    return str(value)


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a description of the difference."""
    got_rows, got_columns = df.collect(), df.columns
    answer = con.execute(sql)
    want_columns = [d[0] for d in answer.description]
    want_rows = answer.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    got, want = _bag(got_rows, got_columns), _bag(want_rows, want_columns)
    if got == want:
        return None
    return (
        f"rows {len(got_rows)} / {len(want_rows)}; only here {list((got - want).items())[:3]}; "
        f"only oracle {list((want - got).items())[:3]}"
    )


def main():
    import __spark_entry__ as e
    from closebell.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    oracles = e.oracle_sql()
    for name, build in e.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            if name in oracles:
                df = build(spark, sf_dir)
                n = None
                diff = compare(df, con, oracles[name])
            else:
                n, diff = build(spark, sf_dir).count(), None
        except Exception as err:  # report and go on with the next query
            diff = f"{type(err).__name__}: {str(err)[:1500]}"
        if diff:
            bad.append(name)
        print(f"{name:24} {time.time() - t:6.2f}s {'ok' if not diff else diff}", flush=True)
    print("FAILED: " + " ".join(bad) if bad else "all equal")
    spark.stop()
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
