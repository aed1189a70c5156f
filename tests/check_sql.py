"""Compare every registered query with its SQL on DuckDB: ``python tests/check_sql.py <dir> [name ...]``."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(repr(_cell(row[i])) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table)


def compare(con, name, df, sql):
    """None when both sides agree, else a short account of the difference."""
    left_columns, left = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    right_columns, right = canonical([d[0] for d in result.description], result.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} / {right_columns}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"values {a} / {b}"
    return None


def main(sf_dir, names):
    from conftest import make_session
    from __spark_entry__ import oracle_sql, queries

    spark = make_session()
    con, sql, failed = connect(sf_dir), oracle_sql(), []
    for name, function in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            if name in sql:
                outcome = compare(con, name, df, sql[name])
            else:
                outcome = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if outcome is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              f"{'' if name in sql else ' (rows only)'} {outcome or ''}", flush=True)
        if outcome:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], set(sys.argv[2:])))
