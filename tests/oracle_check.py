"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf] [name-prefix ...]``.

Columns are sorted by name; types must agree by family; rows are compared as a sorted multiset, floats exactly.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def normal(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else repr(v + 0.0))
    if isinstance(v, int):
        return (3, str(v))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, (list, tuple)):
        return (6, str([normal(x) for x in v]))
    return (5, str(v))


FAMILY = {"BIGINT": "int", "DOUBLE": "float", "VARCHAR": "str", "DATE": "date", "TIMESTAMP": "ts", "BOOLEAN": "bool"}
SPARK_FAMILY = {
    "bigint": "int", "double": "float", "string": "str", "date": "date", "timestamp_ntz": "ts", "timestamp": "ts",
    "boolean": "bool",
}


def compare(con, df, text):
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rel = con.execute(text)
    dcols = [x[0] for x in rel.description]
    dtypes = [str(x[1]) for x in rel.description]
    drows = rel.fetchall()
    dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
    if [cols[i] for i in order] != [dcols[i] for i in dorder]:
        return f"columns {sorted(set(cols) ^ set(dcols))}"
    types = dict(df.dtypes)
    bad = []
    for i, j in zip(order, dorder):
        a, b = SPARK_FAMILY.get(types[cols[i]], types[cols[i]]), FAMILY.get(dtypes[j], dtypes[j])
        if a != b:
            bad.append(f"{cols[i]}:{a}/{b}")
    if bad:
        return "types " + ", ".join(bad)
    ours = sorted([tuple(normal(r[i]) for i in order) for r in rows])
    theirs = sorted([tuple(normal(r[i]) for i in dorder) for r in drows])
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            diff = [(cols[order[k]], x[1], y[1]) for k, (x, y) in enumerate(zip(a, b)) if x != y]
            return f"value {diff[:4]}"
    return None if ours else "EMPTY (equal)"


def main(argv):
    import __spark_entry__ as entry
    from clientele.session import build_session

    sf = argv[0] if argv else "0.01"
    prefixes = argv[1:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle, failed, slow = entry.oracle_sql(), [], []
    names = [k for k in entry.queries() if not prefixes or any(k.startswith(p) for p in prefixes)]
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            if name in oracle:
                result = compare(con, df, oracle[name])
            else:
                rows = df.collect()
                result = None if rows else "EMPTY"
        except Exception as e:  # noqa: BLE001
            lines = [x for x in str(e).splitlines() if x.strip()]
            result = f"ERROR {type(e).__name__}: {' | '.join(lines[:3])[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        took = time.time() - start
        slow.append((took, name))
        if result:
            failed.append(name)
            print(f"{name:32s} {took:6.2f}s {result}", flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} agree; slowest {[(n, round(t, 1)) for t, n in sorted(slow)[-8:]]}")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
