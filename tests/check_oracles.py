"""Run registered queries against their SQL: python tests/check_oracles.py [sf_dir] [query ...]."""

import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def sorted_rows(rows):
    return sorted(rows, key=repr)


def compare(spark, db, sf_dir, name):
    """Differences between a query and its SQL, empty when they agree."""
    frame = queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted_rows(tuple(row) for row in frame.select(*columns).collect())
    relation = db.sql(oracle_sql()[name])
    if sorted(relation.columns) != columns:
        return [f"columns {columns} against {sorted(relation.columns)}"]
    wanted = sorted_rows(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    if len(got) != len(wanted):
        return [f"{len(got)} rows against {len(wanted)}"]
    return [f"{columns}: {a} against {b}" for a, b in zip(got, wanted) if a != b]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, db, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for problem in problems[:3]:
            print("     ", problem[:900], f"({len(problems)} in all)", flush=True)


if __name__ == "__main__":
    main()
