"""Run registered queries next to their SQL and compare whole results.

    python -m workbench.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter

import duckdb

from tvtrail.session import build
from workbench import catalog

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# DuckDB types and what a column of theirs must be in Spark.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double", "DATE": "date",
}


def _canonical(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    frame = catalog.QUERIES[name](spark, sf_dir)
    got_columns, got = _canonical(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in catalog.ORACLES:
        return True, f"rows only: {sum(got.values())}"
    cursor = con.execute(catalog.ORACLES[name])
    want_columns, want = _canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    kinds, asked = dict(frame.dtypes), {d[0]: str(d[1]) for d in cursor.description}
    other = {c: (kinds[c], asked[c]) for c in got_columns if TYPES.get(asked[c], kinds[c]) != kinds[c]}
    if other:
        return False, f"types {other}"
    if got != want:
        extra, missing = got - want, want - got
        return False, (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"extra {list(extra.items())[:3]} missing {list(missing.items())[:3]} {got_columns}"
        )
    return True, f"rows {sum(got.values())}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    sf_dir = f"{DATA}/sf{args.sf}"
    spark = build("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in args.names or list(catalog.QUERIES):
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
