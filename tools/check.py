"""Run registered queries next to their SQL and report differences.

python tools/check.py [name ...]      SF_DIR selects the data (default sf0.001)
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def session():
    from pyspark.sql import SparkSession

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("panelwright")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    """A value in a form both engines share."""
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def compare(df, sql: str, con) -> str | None:
    """None when both sides agree, else what differs."""
    names = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    cursor = con.execute(sql)
    have = [d[0] for d in cursor.description]
    if sorted(have) != names:
        return f"columns {names} != {sorted(have)}"
    at = [have.index(c) for c in names]
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}; first {ours[:2]} {theirs[:2]}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference {names}: {a} != {b}"
    return None if ours else "no rows"


def main(names: list[str]) -> int:
    from suite import registered

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
    spark, con = session(), database(sf)
    failed = 0
    for name, (run, sql) in registered().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            problem = compare(df, sql, con) if sql else (None if df.count() else "no rows")
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {'' if sql else '(rows only)'} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
