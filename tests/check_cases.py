"""Run cases next to their SQL in DuckDB and compare schema and every value.

    python -m tests.check_cases [folder] [case ...]

PLAIN_SESSION=1 uses a session without the recommended settings.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SAME_TYPE = {
    "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def kind(text: str) -> str:
    return text.lower() if text.startswith("DECIMAL") else SAME_TYPE.get(text, f"?{text}")


def compare(db, frame, sql: str | None) -> list[str]:
    """What differs between a frame and the result of the SQL; empty if nothing does."""
    columns = sorted(frame.columns)
    rows = [tuple(row) for row in frame.select(*columns).collect()]
    if sql is None:
        return [] if rows else ["no rows"]
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    raw = cursor.fetchall()
    problems = []
    if sorted(names) != columns:
        return [f"columns {columns} against {sorted(names)}"]
    types = dict(db.execute(f"select column_name, column_type from (describe {sql})").fetchall())
    for field in frame.schema:
        if kind(types[field.name]) != field.dataType.simpleString():
            problems.append(f"{field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    place = [names.index(c) for c in columns]
    ours, theirs = Counter(rows), Counter(tuple(r[i] for i in place) for r in raw)
    if ours != theirs:
        problems.append(f"{len(rows)} rows against {len(raw)}; only ours {list((ours - theirs).items())[:3]}; "
                        f"only theirs {list((theirs - ours).items())[:3]}")
    elif not rows:
        problems.append("no rows on either side")
    return problems


def main() -> int:
    from cases import CASES
    from millrace.session import local_session
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(CASES)
    if os.environ.get("PLAIN_SESSION") == "1":
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = local_session(8)
    db, bad = connect(folder), 0
    for name in wanted:
        start = time.time()
        try:
            problems = compare(db, CASES[name].run(spark, folder), CASES[name].sql)
        except Exception as error:  # report and go on with the next case
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - start:6.2f}s {name}", flush=True)
        for problem in problems:
            print("      ", problem)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
