"""Runs queries of the entry against their SQL: python tests/compare.py SF_DIR NAME..."""

import math
import sys
import time
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else p / '*.parquet'}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return v if v is None or isinstance(v, (int, str, bool)) else repr(v)


def differences(df, con, sql):
    """Counts and examples of rows that only one side has."""
    rel = con.sql(sql)
    cols = sorted(df.columns)
    if cols != sorted(rel.columns):
        return f"columns {cols} and {sorted(rel.columns)}"
    a = sorted((tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)
    b = sorted((tuple(plain(v) for v in r) for r in con.sql(f"SELECT {', '.join(f'"{c}"' for c in cols)} FROM ({sql})").fetchall()), key=repr)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return f"{len(a)} and {len(b)} rows; only Spark {sorted(sa - sb, key=repr)[:3]}; only SQL {sorted(sb - sa, key=repr)[:3]}"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as e

    from tidewell.session import build

    spark = build()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sys.argv[1])
    for name in sys.argv[2:] or list(e.queries()):
        t = time.time()
        try:
            df = e.queries()[name](spark, sys.argv[1])
            if name in e.oracle_sql():
                print(name, differences(df, con, e.oracle_sql()[name]) or "same", f"{time.time() - t:.1f} s", flush=True)
            else:
                print(name, "no SQL;", df.count(), "rows", f"{time.time() - t:.1f} s", flush=True)
        except Exception as x:
            print(name, "FAILED", str(x)[:1500], flush=True)
