"""Run registered queries beside their oracle SQL in DuckDB and compare the rows.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keptvisit.sources.fixtures import TABLES  # noqa: E402

KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "integer": "int", "hugeint": "hugeint",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "date": "date",
    "timestamp": "time", "timestamp_ntz": "time", "boolean": "bool",
}


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value):
    if value is None:
        return ("",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int,)):
        return ("n", float(value))
    if isinstance(value, (float, decimal.Decimal)):
        return ("n", round(float(value), 6) + 0.0)
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("d", value.isoformat())
    return ("s", str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(con, frame, sql):
    """A list of differences; empty when both sides agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    theirs = result.fetchall()
    ours = frame.collect()
    problems = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} / {sorted(names)}"]
    for name, kind in frame.dtypes:
        if KINDS.get(kind, kind) != KINDS.get(kinds[name], kinds[name]):
            problems.append(f"type of {name}: {kind} / {kinds[name]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} / {len(theirs)}")
    a, b = rows_of(frame.columns, ours), rows_of(names, theirs)
    if a != b:
        extra = sorted(set(a) - set(b))[:2]
        missing = sorted(set(b) - set(a))[:2]
        problems.append(f"values ({sorted(names)})\n   ours   {extra}\n   theirs {missing}")
    return problems


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"

    import __spark_entry__ as entry
    from keptvisit.session import build_session

    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in oracles:
                problems = compare(con, frame, oracles[name])
                note = "same"
            else:
                problems, note = [], f"{frame.count()} rows, no oracle"
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s",
              "; ".join(problems) or note, flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
