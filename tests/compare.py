"""Strict comparison of a registered query with its DuckDB statement: names, types, rows.

Run as a script to check queries by name prefix: ``python tests/compare.py sf0.01 k1 q2``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def differences(frame, con, sql: str) -> str | None:
    """None when both sides agree, otherwise what differs first."""
    names = sorted(frame.columns)
    cursor = con.execute(sql)
    theirs = {c[0]: str(c[1]).upper() for c in cursor.description}
    if sorted(theirs) != names:
        return f"columns {names} against {sorted(theirs)}"
    order = [c[0] for c in cursor.description]
    place = [order.index(name) for name in names]
    wanted = Counter(tuple(row[i] for i in place) for row in cursor.fetchall())
    found = Counter(tuple(row[name] for name in names) for row in frame.collect())
    types = dict(frame.dtypes)
    described = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    for name in names:
        kind = types[name].upper() if types[name].startswith("decimal") else KINDS.get(types[name], types[name])
        if kind != described[name].replace(" ", ""):
            return f"type of {name}: {kind} against {described[name]}"
    if found != wanted:
        extra, lost = list((found - wanted).items()), list((wanted - found).items())
        rows = f"{sum(found.values())} rows against {sum(wanted.values())}"
        return f"{rows}; {len(extra)} differ\n  {names}\n  spark {sorted(map(str, extra))[:2]}\n  duck  {sorted(map(str, lost))[:2]}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tallyhouse.session import local_session

    scale, prefixes = sys.argv[1], sys.argv[2:] or [""]
    sf_dir = f"/root/testdata/{scale}"
    spark = local_session(8)
    con = duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            problem = differences(frame, con, sql[name]) if name in sql else f"rows only: {len(frame.collect())}"
        except Exception as error:  # noqa: BLE001  (report and go on to the next query)
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem and name in sql)
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("unmatched statements:", sorted(set(sql) - set(queries)), "differing:", bad)


if __name__ == "__main__":
    main()
