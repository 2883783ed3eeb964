"""Compare a Spark query with its check SQL row by row.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con



def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: str([(v is None, f"{v:.3f}" if isinstance(v, float) else str(v)) for v in r]))


def same_value(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def difference(spark_columns, spark_rows, duck_columns, duck_rows) -> str | None:
    """What differs first, or None."""
    ca, ra = normal(list(spark_columns), spark_rows)
    cb, rb = normal(list(duck_columns), duck_rows)
    if ca != cb:
        return f"columns: only spark {set(ca) - set(cb)}, only sql {set(cb) - set(ca)}"
    if len(ra) != len(rb):
        return f"rows: spark {len(ra)}, sql {len(rb)}"
    bad = [(x, y) for x, y in zip(ra, rb) if not all(same_value(a, b) for a, b in zip(x, y))]
    if bad:
        x, y = bad[0]
        cells = [(c, a, b) for c, a, b in zip(ca, x, y) if not same_value(a, b)]
        return f"{len(bad)} of {len(ra)} rows differ; first: {cells[:6]} in {x[:8]}"
    return None


def main() -> None:
    from adtrail.session import local_session

    import __spark_entry__ as entry

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), duck(sf_dir)
    oracle, failed, total = entry.oracle_sql(), [], 0.0
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            cur = con.execute(oracle[name])
            found = difference(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
        except Exception as error:  # report and go on with the next query
            took, found, rows = time.time() - start, f"ERROR {str(error)[:400]}", []
        total += took
        if found:
            failed.append(name)
        print(f"{'FAIL' if found else 'ok  '} {name:34s} {len(rows):7d} {took:6.2f}s {found or ''}".replace("\n", " "), flush=True)
    print(f"failed {len(failed)}: {failed}; {total:.0f}s")


if __name__ == "__main__":
    main()
