"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def normal(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    table = table.select(sorted(table.column_names))
    kinds = [(f.name, _kind(f.type)) for f in table.schema]
    rows = list(zip(*[c.to_pylist() for c in table.columns])) if table.num_columns else []
    return kinds, sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(spark_table: pa.Table, sql_table: pa.Table) -> str:
    """'' if equal, else what differs."""
    left_kinds, left = normal(spark_table)
    right_kinds, right = normal(sql_table)
    if left_kinds != right_kinds:
        return f"schema {[k for k in left_kinds if k not in right_kinds]} vs {[k for k in right_kinds if k not in left_kinds]}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b and not (str(a) == str(b))]
    return f"{len(bad)} rows differ, e.g.\n  {str(bad[0][0])[:1500]}\n  {str(bad[0][1])[:1500]}" if bad else ""


def main(names: list[str], sf_dir: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from newsloom.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and not any(n in name for n in names):
            continue
        try:
            start = time.time()
            table = fn(spark, sf_dir).toArrow()
            spent = time.time() - start
            if name not in oracles:
                print(f"{name:32} {spent:6.2f}s  rows {table.num_rows} (no SQL)")
                continue
            start = time.time()
            wanted = con.sql(oracles[name]).to_arrow_table()
            what = differences(table, wanted)
            print(f"{name:32} {spent:6.2f}s {time.time() - start:6.2f}s  rows {table.num_rows} {'ok' if not what else 'DIFFERS: ' + what}", flush=True)
            failed += bool(what)
        except Exception as e:  # keep going, show all failures
            print(f"{name:32} ERROR {type(e).__name__}: {str(e)[:1200]}", flush=True)
            failed += 1
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    pd.set_option("display.width", 200)
    sf = "/root/testdata/sf0.01"
    args = [a for a in sys.argv[1:] if not a.startswith("/")]
    sf = next((a for a in sys.argv[1:] if a.startswith("/")), sf)
    raise SystemExit(main(args, sf) > 0)
