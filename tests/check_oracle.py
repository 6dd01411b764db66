"""Compare catalog queries with their SQL twins: ``python -m tests.check_oracle [sf] [name ...]``."""

import sys
import tempfile
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of (class, value), strict about text, number and boolean."""

    def cell(v):
        if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NA or v is pd.NaT:
            return ("null", "")
        if isinstance(v, (bool,)) or type(v).__name__ in ("bool", "bool_"):
            return ("bool", str(bool(v)))
        if isinstance(v, str):
            return ("text", v)
        return ("num", repr(round(float(v), 9) + 0.0))

    columns = sorted(frame.columns)
    return sorted(tuple(cell(v) for v in row) for row in frame[columns].itertuples(index=False))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    ours, theirs = _plain(spark_frame), _plain(sql_frame)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            cells = [(c, x[1][:200], y[1][:200])
                     for c, x, y in zip(sorted(spark_frame.columns), a, b) if x != y]
            return f"differs: {cells}"
    return None


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewire-oracle-"))
        .config("spark.tidewire.text.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    names = sys.argv[2:] or list(entry.queries())
    failed = []
    for name in names:
        try:
            started = time.time()
            ours = entry.queries()[name](spark, sf_dir).toPandas()
            spent = time.time() - started
            sql = entry.oracle_sql().get(name)
            problem = difference(ours, db.execute(sql).df()) if sql else None
        except Exception as exc:
            problem, spent, ours = f"{type(exc).__name__}: {str(exc)[:1500]}", 0.0, []
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {len(ours):7d} rows {spent:6.2f}s "
              f"{problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
