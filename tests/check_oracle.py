"""Run queries next to their oracle SQL: python tests/check_oracle.py [--sf 0.01] [names or prefixes]."""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    spark_cols = df.columns
    result = con.execute(sql)
    duck_cols = [d[0] for d in result.description]
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns {sorted(spark_cols)} != {sorted(duck_cols)}"
    order = sorted(spark_cols)
    left = [tuple(r[c] for c in order) for r in df.collect()]
    at = [duck_cols.index(c) for c in order]
    right = [tuple(r[i] for i in at) for r in result.fetchall()]

    def typed(rows):
        return Counter(tuple((type(v).__name__, v) for v in r) for r in rows)

    a, b = typed(left), typed(right)
    if a == b:
        return None if left else "EMPTY"
    only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
    return f"rows {len(left)}/{len(right)} cols {order}\n   spark {only_a}\n   duck  {only_b}"


def main() -> int:
    import __spark_entry__ as entry
    from millrace.session import local_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = local_session()
    folder = opts.sf if "/" in opts.sf else f"/root/testdata/sf{opts.sf}"
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if opts.names and not any(name.startswith(n) for n in opts.names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(fn(spark, folder), con, oracles[name])
            else:
                problem = None if fn(spark, folder).count() else "EMPTY"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:5.1f}s {name}", problem or "", flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
