"""Compare registered queries with their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def spark_types(frame) -> dict[str, str]:
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "date": "DATE", "boolean": "BOOLEAN"}
    return {name: names.get(kind, kind) for name, kind in frame.dtypes}


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def difference(frame, db, sql: str) -> str | None:
    """What differs between a Spark frame and a DuckDB query, or ``None``."""
    result = db.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = spark_types(frame)
    if ours != theirs:
        odd = {k: (ours.get(k), theirs.get(k)) for k in ours.keys() | theirs.keys() if ours.get(k) != theirs.get(k)}
        return f"schema: {odd}"
    names = sorted(ours)
    order = [d[0] for d in result.description]
    right = sorted(
        tuple(normal(row[order.index(n)]) for n in names) for row in result.fetchall()
    )
    left = sorted(tuple(normal(row[n]) for n in names) for row in frame.select(*names).collect())
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(bad)} of {len(left)} rows differ, first: {cells[:4]}"
    return None


def main(argv: list[str]) -> int:
    from checks.oracle import oracle_sql
    from checks.registry import queries
    from tests.conftest import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, db = local_session(), connect(sf_dir)
    registered, texts = queries(), oracle_sql()
    failures = 0
    for name in argv[1:] or registered:
        started = time.time()
        try:
            frame = registered[name](spark, sf_dir)
            if name in texts:
                problem = difference(frame, db, texts[name])
            else:
                problem = None if frame.count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - started:.1f}s)", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
