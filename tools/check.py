"""Compare registered queries with their SQL: python tools/check.py [--sf 0.01] [name ...]"""

from __future__ import annotations

import argparse
import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.catalog import QUERIES, SQL  # noqa: E402
from millrace.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return bool(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value + 0.0:.9g}"
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


def summary(columns: list[str], rows) -> tuple[int, str, list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([plain(row[i]) for i in order]) for row in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--times", action="store_true", help="run Spark alone")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = local_session()
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    failed = []
    for name in args.names or list(QUERIES):
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            rows = [tuple(r) for r in frame.collect()]
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            failed.append(name)
            continue
        spent = time.time() - start
        count, digest, lines = summary(frame.columns, rows)
        if name not in SQL or args.times:
            print(f"rows  {name} {count} rows, spark {spent:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            cursor = duck.execute(SQL[name])
            columns = [d[0] for d in cursor.description]
            types = [str(d[1]) for d in cursor.description]
            wanted = cursor.fetchall()
        except Exception as error:
            print(f"SQLERR {name}: {str(error)[:800]}", flush=True)
            failed.append(name)
            continue
        sql_spent = time.time() - start
        sql_count, sql_digest, sql_lines = summary(columns, wanted)
        same = sorted(columns) == sorted(frame.columns) and digest == sql_digest
        print(
            f"{'ok   ' if same else 'DIFF '} {name} {count}/{sql_count} rows, spark {spent:.1f}s, sql {sql_spent:.1f}s",
            flush=True,
        )
        kinds = dict(zip(columns, types))
        for column, kind in frame.dtypes:
            if KINDS.get(kind, kind) != kinds.get(column):
                print(f"      TYPE {name}.{column}: {kind} against {kinds.get(column)}", flush=True)
        if not same:
            failed.append(name)
            print("      spark", frame.dtypes)
            print("      sql  ", list(zip(columns, types)))
            only_spark, only_sql = set(lines) - set(sql_lines), set(sql_lines) - set(lines)
            print("      only spark", len(only_spark), sorted(only_spark)[:3])
            print("      only sql  ", len(only_sql), sorted(only_sql)[:3], flush=True)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
