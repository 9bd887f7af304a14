"""Run registered queries next to their SQL: ``python -m checks.compare [sf_dir] [query...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as text tuples, columns by name, in a fixed order."""

    def show(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "NULL"
        return repr(float(value)) if isinstance(value, float) else str(value)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(show, row)) for row in frame.itertuples(index=False))


def difference(spark, con, name: str, sf_dir: str, queries=QUERIES, oracle=ORACLE) -> str | None:
    """What differs between the query and its SQL, or None."""
    rows = queries[name](spark, sf_dir)
    mine = rows.toPandas()
    for column, kind in rows.dtypes:
        if kind in ("int", "bigint") and mine[column].dtype.kind == "f":  # pandas turns integers with a NULL to floats
            mine[column] = mine[column].astype("Int64")
    theirs = con.execute(oracle[name]).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    a, b = canonical(mine), canonical(theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}"
    # Time columns may differ in unit only.
    kinds = {
        c: (mine[c].dtype, theirs[c].dtype) for c in mine if mine[c].dtype.kind != theirs[c].dtype.kind
    }
    return f"types {kinds}" if kinds else None


def main(sf_dir: str = DEFAULT_DIR, *names: str) -> int:
    from tallystar.session import build

    spark = build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        begun = time.time()
        try:
            found = difference(spark, con, name, sf_dir) if name in ORACLE else "no SQL"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:26s} {time.time() - begun:6.2f}s  {found or 'ok'}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
