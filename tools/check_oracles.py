"""Run registered queries beside their SQL in DuckDB and compare the rows.

    python tools/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fieldsync.catalog.oracles import ORACLES  # noqa: E402
from fieldsync.catalog.queries import REGISTERED  # noqa: E402
from fieldsync.session import local_session  # noqa: E402


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in records)


def connect(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, name, sf_dir):
    """None when equal, else what differs."""
    return compare_rows(REGISTERED[name](spark, sf_dir), con, name)


def compare_rows(df, con, name):
    mine = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return None if mine else "no rows"
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if mine != theirs:
        first = next(((a, b) for a, b in zip(mine, theirs, strict=False) if a != b), None)
        return f"{len(mine)} / {len(theirs)} rows, first difference {first}"
    return None if mine else "no rows on either side"


if __name__ == "__main__":
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session(cores=8)
    con = connect(directory)
    failed = 0
    for query in sys.argv[2:] or REGISTERED:
        began = time.time()
        try:
            problem = compare(session, con, query, directory)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{query:24s} {time.time() - began:6.1f}s {'ok' if problem is None else problem}", flush=True)
    sys.exit(1 if failed else 0)
