"""Run the registered queries beside their SQL: python tests/check_oracle.py <sf> [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def clean(v):
        if isinstance(v, bool) or v is None:
            return v
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            v = float(v)
            return None if math.isnan(v) else round(v, 6) + 0.0
        return v

    return sorted(columns), sorted((tuple(clean(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None, len(got[1]), []
    rel = con.execute(sql)
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return False, len(got[1]), [got[0], want[0]]
    diff = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return got == want, len(got[1]), [len(want[1])] + diff[:3]


def main() -> int:
    import __spark_entry__ as entry
    from ringsight.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = local_session(), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            ok, n, diff = compare(spark, con, queries[name], sql.get(name), sf_dir)
        except Exception as error:  # report and go on
            ok, n, diff = False, -1, [str(error)[:600]]
        state = "rows" if ok is None else "ok" if ok else "FAIL"
        print(f"{state:5} {name:36} {n:7} rows {time.time() - start:6.1f}s", *([] if ok or ok is None else diff), flush=True)
        if ok is False:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
