"""Run catalogue queries on Spark and their SQL twins on DuckDB and compare the rows.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, Decimal):
        return round(float(value), 6)
    return value


def _rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in records)


def compare(spark, con, name: str, run, sql: str, sf_dir: str) -> list[str]:
    """Differences in columns and rows, empty if there are none."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = dict(zip(names, [str(d[1]) for d in cursor.description]))
    want = _rows(names, cursor.fetchall())
    faults = []
    if sorted(df.columns) != sorted(names):
        return [f"{name}: columns {sorted(df.columns)} != {sorted(names)}"]
    widths = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    for field in df.schema:
        kind = field.dataType.simpleString()
        if widths.get(kind) != kinds[field.name]:
            faults.append(f"{name}: type of {field.name} {kind} / {kinds[field.name]}")
    if got != want:
        faults.append(
            f"{name}: {sum(got.values())} rows against {sum(want.values())}; "
            f"only Spark {list((got - want).items())[:2]}; only SQL {list((want - got).items())[:2]}"
        )
    if not want:
        faults.append(f"{name}: no rows")
    return faults


def main(argv) -> int:
    from __spark_entry__ import oracle_sql, queries
    from parcelflow.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        begun = time.time()
        try:
            if name in sqls:
                faults = compare(spark, con, name, run, sqls[name], sf_dir)
            else:
                faults = [] if run(spark, sf_dir).count() else [f"{name}: no rows"]
        except Exception as error:
            faults = [f"{name}: {type(error).__name__} {str(error)[:600]}"]
        bad += bool(faults)
        print(f"{'FAIL' if faults else 'ok'} {name} {time.time() - begun:.1f}s", *faults, sep="\n   " if faults else " ", flush=True)
    print(f"{bad} of {len(queries())} differ")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
