"""Compare registered queries with their check SQL: ``python -m testbed.check <dir> [name ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time

import duckdb

from testbed.oracle import oracle_sql
from testbed.queries import REGISTRY
from testbed.tables import GIVEN


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
              "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else a description of the first difference."""
    df = REGISTRY[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    cur = con.execute(oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    want = _rows(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lacking = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} != {len(want)}\n   columns {sorted(columns)}\n   only spark {extra}\n   only sql {lacking}"
    types = [(c, t, kinds[c]) for c, t in df.dtypes if SPARK_KIND.get(t) != kinds[c]]
    return f"types differ: {types}" if types else None


def main(argv: list[str]) -> int:
    from pressgauge.session import local_session

    sf_dir, names = argv[0], argv[1:] or list(REGISTRY)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
