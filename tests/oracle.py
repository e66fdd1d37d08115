"""Compare registered queries with their oracle SQL in DuckDB, insensitive to row and column order."""

from __future__ import annotations

import sys

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = [
            None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA else
            repr(float(v)) if isinstance(v, float) else str(v)
            for v in df[c].astype(object)
        ]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: df[c].dtype.kind for c in sorted(df.columns)}


def whole(df: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """``columns`` as nullable integers where pandas made them floats for their nulls."""
    return df.astype({c: "Int64" for c in columns if df[c].dtype.kind == "f" and (df[c].dropna() % 1 == 0).all()})


def check(spark, con, folder: str, name: str, fn, sql: str) -> str | None:
    """None when equal, else the difference."""
    found = fn(spark, folder)
    got, want = found.toPandas(), con.execute(sql).df()
    nullable = [c for c, t in found.dtypes if t in ("tinyint", "smallint", "int", "bigint") and got[c].dtype.kind == "f"]
    got, want = whole(got, nullable), whole(want, [c for c in nullable if c in want])
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    if not a.equals(b):
        bad = (a.fillna("~") != b.fillna("~")).any(axis=1)
        return f"values differ in {bad.sum()} rows:\n{a[bad].head(3)}\n{b[bad].head(3)}"
    if kinds(got) != kinds(want):
        return f"WARN kinds {kinds(got)} != {kinds(want)}"
    return None


def main(folder: str, *names: str) -> int:
    import time

    sys.path.insert(0, ".")
    import __spark_entry__ as contract
    from tidegrid.session import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    oracles = contract.oracle_sql()
    for name, fn in contract.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = check(spark, con, folder, name, fn, oracles[name])
            else:
                problem = None if len(fn(spark, folder).toPandas()) else "no rows"
        except Exception as error:  # noqa: BLE001 - report every query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {'' if name in oracles else '(rows)'} {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(*sys.argv[1:])))
