"""Run registered queries and their SQL form side by side.

    python -m millrace.compare /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

from millrace.registry import registered
from millrace.session import build_session
from millrace.sources.tables import SCHEMAS


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def sql_rows(folder: str, text: str):
    import duckdb

    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cursor = con.execute(text)
    columns = [d[0] for d in cursor.description]
    return normal_rows(columns, cursor.fetchall())


def difference(spark_side, sql_side) -> str | None:
    """None when equal, else a short text."""
    (c1, r1), (c2, r2) = spark_side, sql_side
    if c1 != c2:
        return f"columns {c1} and {c2}"
    if len(r1) != len(r2):
        return f"row counts {len(r1)} and {len(r2)}; first {r1[:2]} and {r2[:2]}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    folder, prefixes = argv[0], tuple(argv[1:])
    spark = build_session("local[8]", partitions=8)
    failed = 0
    for name, q in registered().items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            df = q.run(spark, folder)
            got = normal_rows(df.columns, df.collect())
            spent = time.time() - started
            if q.sql is None:
                print(f"rows {name} {spent:.1f}s {len(got[1])} rows {got[1][:2]}", flush=True)
                continue
            started = time.time()
            message = difference(got, sql_rows(folder, q.sql))
            lap = time.time() - started
            failed += message is not None
            print(f"{'FAIL' if message else 'ok  '} {name} {spent:.1f}s sql {lap:.1f}s {len(got[1])} rows {message or ''}", flush=True)
        except Exception as error:
            failed += 1
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
