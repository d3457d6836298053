"""Compares registered queries with their SQL on DuckDB: python tests/oracle.py FOLDER [NAME...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        own = f"{folder}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{own}/*.parquet')" if os.path.isdir(own) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{own}')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    same = lambda x: f"{x:.5f}" if isinstance(x, float) else str(x)
    return sorted(names), sorted(tuple(same(r[i]) for i in order) for r in rows)


def compare(con, df, sql):
    """(number of rows, None or what differs)."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in rel.fetchall()])
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} and {want[0]}"
    if len(got[1]) != len(want[1]):
        return len(got[1]), f"{len(got[1])} rows and {len(want[1])}"
    return len(got[1]), next((f"{a} and {b}" for a, b in zip(got[1], want[1]) if a != b), None)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sys.argv[1]), entry.oracle_sql()
    for name, q in entry.queries().items():
        if not sys.argv[2:] or name in sys.argv[2:]:
            began = time.time()
            try:
                n, off = compare(con, q(spark, sys.argv[1]), oracle[name]) if name in oracle else (q(spark, sys.argv[1]).count(), "no SQL")
            except Exception as e:  # shown, and the next query follows
                n, off = -1, repr(e)[:600]
            print(f"{'ok  ' if off is None else 'FAIL' if off != 'no SQL' else 'rows'} {name} {n} rows {time.time() - began:.1f} s {off or ''}", flush=True)
