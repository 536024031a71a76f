"""Compare every registered query with its SQL: columns, row count and values regardless of order."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def difference(spark_df, db, sql: str) -> str | None:
    """None when equal, else what differs first."""
    got_columns = sorted(spark_df.columns)
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != got_columns:
        return f"columns {got_columns} vs {sorted(names)}"
    order = [names.index(name) for name in got_columns]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    got = Counter(tuple(_plain(v) for v in row) for row in spark_df.select(*got_columns).collect())
    if want == got:
        return None
    extra, lacking = got - want, want - got
    return f"rows {sum(got.values())} vs {sum(want.values())}; only here {list(extra)[:2]}; only in SQL {list(lacking)[:2]}; {kinds}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from salesmart.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:] or list(e.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    sqls = e.oracle_sql()
    print("without SQL:", sorted(set(e.queries()) - set(sqls)), "SQL only:", sorted(set(sqls) - set(e.queries())))
    for name in wanted:
        began = time.time()
        try:
            outcome = difference(e.queries()[name](spark, sf_dir), db, sqls[name]) or "ok"
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {str(error)[:1500]}"
        print(f"{name:26s} {time.time() - began:6.2f}s {outcome}", flush=True)
