"""Compare every registered query with its SQL; usable as a script: ``python tests/oracle_check.py DIR [name ...]``."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, fn, sql, sf_dir):
    """Empty text when both sides agree, else what differs."""
    got = fn(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(set(got.columns) ^ set(names))}"
    left, right = rows_of(got.columns, got.collect()), rows_of(names, cursor.fetchall())
    if left == right:
        return ""
    return f"{sum(left.values())} vs {sum(right.values())} rows; only spark {list((left - right))[:2]}; only sql {list((right - left))[:2]}"


def main():
    from __spark_entry__ import oracle_sql, queries
    from leadlake.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, fn, sql[name], sf_dir) if name in sql else f"no sql, {fn(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
