"""Run every registered query beside its SQL: ``python tests/check_oracles.py [sf_dir] [names...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from textmill.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='run-')}'")
    con.execute("SET max_temp_directory_size = '2GB'")
    con.execute("SET memory_limit = '8GB'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, values as text."""
    frame = frame[sorted(frame.columns)]
    out = pd.DataFrame(index=frame.index)
    for name in frame.columns:
        column = frame[name]
        null = column.isna()
        if pd.api.types.is_float_dtype(column):
            text = column.map(lambda v: repr(int(v)) if pd.notna(v) and float(v).is_integer() else repr(v))
        else:
            text = column.astype(str)
        out[name] = text.mask(null, "<null>")
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal as multisets of rows, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = normal(got), normal(want)
    if a.equals(b):
        return None
    both = a.merge(b, how="outer", indicator=True)
    return "values\n" + both[both["_merge"] != "both"].head(6).to_string(max_colwidth=120)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            result = queries[name](spark, sf_dir)
            got = result.toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"ROWS  {name} {len(got)} {took:.2f}s", flush=True)
                continue
            cursor = con.execute(oracles[name])
            want = cursor.df()
            types = {d[0]: str(d[1]) for d in cursor.description}
            problem = difference(got, want)
            print(f"{'FAIL' if problem else 'ok  '}  {name} {len(got)} {took:.2f}s", flush=True)
            if problem:
                bad += 1
                print(problem, flush=True)
            mine = dict(result.dtypes)
            pairs = {c: (mine[c], types.get(c)) for c in mine}
            odd = {c: p for c, p in pairs.items() if not same_type(*p)}
            if odd:
                print("      types", odd, flush=True)
        except Exception:
            bad += 1
            print(f"ERROR {name}\n{traceback.format_exc()[-1800:]}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


SAME = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def same_type(spark_type: str, duck_type: str | None) -> bool:
    return SAME.get(spark_type) == duck_type


if __name__ == "__main__":
    sys.exit(main())
