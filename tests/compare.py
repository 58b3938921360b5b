"""Runs registered queries next to their SQL counterparts and compares the rows as multisets."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_frame, connection, sql: str) -> list[str]:
    """What differs, in words; empty when both sides agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(spark_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} against {sorted(names)}"]
    expected = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                "timestamp": "TIMESTAMP"}
    problems = [
        f"type of {name}: {kind} against {kinds[name]}"
        for name, kind in spark_frame.dtypes if expected.get(kind) != kinds[name]
    ]
    ours = _rows(spark_frame.columns, spark_frame.collect())
    theirs = _rows(names, result.fetchall())
    if ours != theirs:
        only = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        problems.append(f"{sum(ours.values())} rows against {sum(theirs.values())}: {only}")
    return problems


def main(folder: str, wanted: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as contract
    from riskstream.session import build_session

    spark = build_session(master="local[8]", extra={"spark.sql.shuffle.partitions": "8",
                                                    "spark.ui.enabled": "false",
                                                    "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, failed = duck(folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            if name in sqls:
                problems = differences(frame, connection, sqls[name])
            else:
                rows = frame.collect()
                problems = []
                print(f"      {len(rows)} rows, first {rows[:2]}")
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else "ok  " if name in sqls else "rows"
        print(f"{mark} {name} {time.time() - start:.1f}s {' | '.join(problems)[:900]}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
