"""Run a query on Spark and its SQL on DuckDB, and compare every cell.

    python tests/oracle.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from gatelog.catalog.all import EXPECTED, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """Human-readable differences; empty when results agree exactly."""
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    relation = con.execute(EXPECTED[name])
    columns = [d[0] for d in relation.description]
    want_columns, want = _sorted(columns, relation.fetchall())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    found = []
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    for g, w in zip(got, want):
        if g != w or [type(a) for a in g] != [type(a) for a in w]:
            found.append(f"{dict(zip(got_columns, g))} != {dict(zip(got_columns, w))}")
            if len(found) > 2:
                break
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in QUERIES:
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in EXPECTED:
                found = differences(spark, con, name, sf_dir)
            else:
                found = []
                print(name, "no SQL,", QUERIES[name](spark, sf_dir).count(), "rows")
        except Exception as error:  # report and go on to the next query
            found = [str(error)[:1500]]
        bad += bool(found)
        rows = con.execute(f"SELECT count(*) FROM ({EXPECTED[name]})").fetchall()[0][0] if (
            name in EXPECTED and not found) else "-"
        print("BAD" if found else "ok ", name, rows, f"{time.time() - start:.2f}s", *found[:3],
              sep="  ")
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
