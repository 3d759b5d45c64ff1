"""Compares each query with its SQL text: names, row count, values as a multiset.

Usage: python -m testbed.check [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from loanlens.session import use_recommended
from testbed import all_queries
from testbed.storage import with_storage

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def compare(df, relation) -> str:
    """Empty when equal, else what differs."""
    left, right = sorted(df.columns), sorted(relation.columns)
    if left != right:
        return f"columns {set(left) ^ set(right)}"
    a = sorted((tuple(_plain(r[c]) for c in left) for r in df.collect()), key=repr)
    order = [relation.columns.index(c) for c in right]
    b = sorted((tuple(_plain(r[i]) for i in order) for r in relation.fetchall()), key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if repr(x) != repr(y):
            diff = [(c, p, q) for c, p, q in zip(left, x, y) if repr(p) != repr(q)]
            n = sum(repr(p) != repr(q) for p, q in zip(a, b))
            return f"{n} rows differ, first {diff[:4]}"
    return ""


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    use_recommended(with_storage(spark)).sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, texts = all_queries()
    names = argv[1:] or list(queries)
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con.sql(texts[name])) if name in texts else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        ok = problem == "" or problem.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'DIFF'} {name:32s} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
