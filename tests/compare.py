"""Runs registered queries against their check SQL: ``python tests/compare.py [glob] [sf]``."""

from __future__ import annotations

import math
import os
import sys
import time
from fnmatch import fnmatchcase
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, canonical(v)) for k, v in value.items())
    if hasattr(value, "asDict"):
        return tuple((k, canonical(v)) for k, v in value.asDict().items())
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(canonical(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def difference(spark_rows, duck_rows) -> str | None:
    columns, rows = spark_rows
    expected_columns, expected = duck_rows
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} != {sorted(expected_columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    left, right = sorted_rows(columns, rows), sorted_rows(expected_columns, expected)
    bad = [(x, y) for x, y in zip(left, right) if x != y]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def check(spark, con, sf_dir, query, sql):
    """(problem or None, Spark seconds, rows, warning)."""
    start = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return None, seconds, len(rows), "rows only"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    problem = difference((df.columns, rows), (names, expected))
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN",
    }
    if problem is None:
        for name, dtype in df.dtypes:
            if dtype in kinds and types[name] not in (kinds[dtype], "STRING", "NUMBER") and types[name] != kinds[dtype]:
                return f"type of {name}: {dtype} != {types[name]}", seconds, len(rows), ""
    return problem, seconds, len(rows), "" if rows else "no rows"


def main() -> int:
    import __spark_entry__ as entry
    from sitepulse.session import local_session

    pattern = sys.argv[1] if len(sys.argv) > 1 else "*"
    sf_dir = f"/root/testdata/sf{sys.argv[2] if len(sys.argv) > 2 else '0.01'}"
    spark, con = local_session(8), duck(sf_dir)
    sqls, failed = entry.oracle_sql(), 0
    slow = []
    for name, query in entry.queries().items():
        if not any(fnmatchcase(name, p) for p in pattern.split(",")):
            continue
        try:
            problem, seconds, rows, note = check(spark, con, sf_dir, query, sqls.get(name))
        except Exception as error:
            problem, seconds, rows, note = f"{type(error).__name__}: {str(error)[:1500]}", 0.0, 0, ""
        failed += problem is not None
        slow.append((seconds, name))
        if problem or note or os.environ.get("VERBOSE"):
            print(f"{'FAIL' if problem else 'ok'} {name} {seconds:.2f}s {rows} rows {note} {problem or ''}", flush=True)
    slow.sort(reverse=True)
    print(f"{len(slow)} queries, {failed} failed, {sum(s for s, _ in slow):.0f}s; slowest {slow[:8]}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
