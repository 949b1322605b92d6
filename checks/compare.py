"""Run every query against its SQL and report what differs.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from checks import oracle, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True, na_position="first")


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """An empty text if both hold the same rows, else what is off."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    got, want = _normal(got), _normal(want)
    kinds = {
        c: (str(got[c].dtype), str(want[c].dtype)) for c in got if str(got[c].dtype) != str(want[c].dtype)
    }
    notes = []
    for c in got:
        a, b = got[c], want[c]
        if pd.api.types.is_numeric_dtype(a) and pd.api.types.is_numeric_dtype(b):
            a, b = a.astype(float), b.astype(float)
        bad = ~((a == b) | (a.isna() & b.isna()))
        if bad.any():
            i = bad[bad].index[0]
            notes.append(f"{c}: {int(bad.sum())} differ, first {a[i]!r} vs {b[i]!r}")
    if kinds:
        notes.append(f"types {kinds}")
    return "; ".join(notes)


def main(argv: list[str]) -> int:
    from wattfold.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, built = connect(sf_dir), oracle.build(), queries.build()
    failed = 0
    for name in argv[1:] or built:
        started = time.time()
        try:
            got = built[name](spark, sf_dir).toPandas()
            took = time.time() - started
            note = differences(got, con.execute(sql[name]).df()) if name in sql else "no SQL"
        except Exception as err:  # report and go on with the next query
            note, took = f"{type(err).__name__}: {str(err)[:600]}", time.time() - started
        failed += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name:28s} {took:6.1f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 99))
