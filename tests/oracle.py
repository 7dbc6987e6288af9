"""Compare a registered query with its SQL, as unordered rows.

Run as a script to check a scale factor: python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Types with the same values under both names.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return tuple(cell(v) for v in value) if isinstance(value, (list, tuple)) else value


def compare(spark, con, sf: str, fn, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    df = fn(spark, sf)
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    odd = {n: (t, theirs[n]) for n, t in ours.items() if TYPES.get(t, t) != theirs[n]}
    if odd:
        return f"types {odd}"
    names = sorted(ours)
    at = {d: i for i, d in enumerate(theirs)}
    left = Counter(tuple(cell(row[n]) for n in names) for row in df.collect())
    right = Counter(tuple(cell(row[at[n]]) for n in names) for row in expected)
    if not right:
        return "the SQL returns no rows"
    if left != right:
        return (
            f"{sum(left.values())} rows against {sum(right.values())}; columns {names}; "
            f"only here {list((left - right).items())[:3]}; only there {list((right - left).items())[:3]}"
        )
    return None


def main() -> int:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from listing_analytics.session import build_session
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                outcome = compare(spark, con, sf, fn, oracles[name])
            else:
                outcome = None if fn(spark, sf).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        failed += outcome is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok  ' if outcome is None else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name} {outcome or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
