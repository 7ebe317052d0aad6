"""Compare registered queries with their check SQL: ``python -m suite.check SF_DIR [name ...]``."""

from __future__ import annotations

import importlib.util
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, oracle) -> str:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if oracle is None:
        return f"rows={len(got[1])}"
    rel = con.sql(oracle)
    want = rows_of(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"MISMATCH columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"MISMATCH rows {len(got[1])} vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"MISMATCH {len(bad)} of {len(got[1])}, e.g.\n   {got[0]}\n   {bad[0][0]}\n   {bad[0][1]}"
    return f"ok {len(got[1])}" + (" EMPTY" if not got[1] else "")


def main(argv) -> int:
    from equisite.plans.session import local_session
    entry, sf_dir, only = load_entry(), argv[0], argv[1:]
    spark, con = local_session(8), connect(argv[0])
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name in only or queries:
        t0 = time.time()
        try:
            result = compare(spark, con, sf_dir, queries[name], oracles.get(name))
        except Exception as exc:
            result = f"ERROR {str(exc)[:700]}"
        failed += not result.startswith(("ok", "rows"))
        print(f"{name:24s} {time.time() - t0:6.2f}s {result}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(ROOT))
    sys.exit(main(sys.argv[1:]))
