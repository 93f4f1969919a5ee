"""Compare every registered query with its SQL twin: python tests/check.py SF_DIR [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_table(sf_dir: str, text: str) -> pa.Table:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con.execute(text).to_arrow_table()


def differences(left: pa.Table, right: pa.Table) -> str | None:
    """None if both hold the same columns, types and rows in any order."""
    left = left.select(sorted(left.column_names))
    right = right.select(sorted(right.column_names))
    if left.column_names != right.column_names:
        return f"columns {left.column_names} vs {right.column_names}"
    kinds = lambda t: [str(f.type).replace("large_", "") for f in t.schema]
    if kinds(left) != kinds(right):
        return f"types {list(zip(left.column_names, kinds(left), kinds(right)))}"
    if left.num_rows != right.num_rows:
        return f"rows {left.num_rows} vs {right.num_rows}"
    keys = [(c, "ascending") for c in left.column_names]
    right = right.cast(left.schema)
    a, b = left.sort_by(keys), right.sort_by(keys)
    for name in a.column_names:
        x, y = a[name].to_pylist(), b[name].to_pylist()
        if list(map(repr, x)) != list(map(repr, y)):
            wrong = [(p, q) for p, q in zip(x, y) if repr(p) != repr(q)]
            return f"column {name}: {len(wrong)} differ, e.g. {wrong[:3]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed = oracle_sql(), []
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = run(spark, sf_dir).toArrow()
            took = time.time() - start
            if name in oracles:
                problem = differences(result, oracle_table(sf_dir, oracles[name]))
                state = "same" if problem is None else problem
            else:
                problem, state = None, "no twin"
        except Exception as error:  # noqa: BLE001
            problem = state = f"{type(error).__name__}: {str(error)[:600]}"
            took, result = time.time() - start, None
        rows = result.num_rows if result is not None else -1
        if problem is not None:
            failed.append(name)
        print(f"{name:28s} {took:7.2f}s {rows:9d} {state}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
