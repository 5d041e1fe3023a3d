"""Compare every checked query with its SQL twin on one data folder.

    python -m tidemark.checks.run [--sf DIR] [name …]
"""

from __future__ import annotations

import argparse
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


# The type each Spark type is compared with.
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP"}


def types_of(frame) -> list[str]:
    return [SQL_TYPES[frame.schema[c].dataType.simpleString()] for c in sorted(frame.columns)]


def rows_of(frame) -> list[tuple]:
    columns = sorted(frame.columns)
    return sorted((tuple(_plain(v) for v in r) for r in frame.select(*columns).collect()), key=repr)


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def oracle(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def expected(con, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr), [kinds[i] for i in order]


def main() -> None:
    from tidemark.checks import QUERIES, SQL
    from tidemark.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    args.add_argument("names", nargs="*")
    given = args.parse_args()
    spark = build_session(master="local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        **dict(c.split("=", 1) for c in given.conf)})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(given.sf)
    bad = 0
    for name in given.names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, given.sf)
            got = rows_of(frame)
        except Exception as error:  # noqa: BLE001 - report and go on
            print(f"FAIL  {name}: {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in SQL:
            print(f"rows  {name}: {len(got)} rows, {took:.1f} s", flush=True)
            continue
        columns, want, kinds = expected(con, SQL[name])
        same = columns == sorted(frame.columns) and kinds == types_of(frame) and got == want
        print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got)} rows, {took:.1f} s", flush=True)
        if not same:
            bad += 1
            print("   ", columns, kinds, [(f.name, f.dataType.simpleString()) for f in frame.schema.fields], len(want))
            here, there = set(got), set(want)
            print("    spark only", [r for r in got if r not in there][:3])
            print("    sql only  ", [r for r in want if r not in here][:3])
    print("all equal" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main()
