"""Run queries and their SQL counterparts side by side.

``python -m checks.compare [folder] [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, nulls alike."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    rows = sorted(frame.itertuples(index=False, name=None), key=repr)
    return pd.DataFrame(rows, columns=frame.columns, dtype=object)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = [
        (c, got[c].dtype, want[c].dtype)
        for c in got.columns
        if len(got) and got[c].dtype != want[c].dtype and "int32" not in str(want[c].dtype)
    ]
    if kinds:
        return f"types {kinds}"
    a, b = normal(got), normal(want)
    if not a.equals(b):
        bad = (a != b) & ~(a.isna() & b.isna())
        rows = bad.any(axis=1)
        return f"{int(rows.sum())} rows differ, e.g.\n{a[rows].head(3)}\n{b[rows].head(3)}"
    return None


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in names:
        began = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            took = time.time() - began
            want = con.execute(ORACLES[name]).df()
            found = difference(got, want)
        except Exception as error:  # report and go on
            took, got, found = time.time() - began, [], f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name:28s} {len(got):7d} rows {took:6.2f} s", found or "", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
