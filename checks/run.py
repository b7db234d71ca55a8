"""Compare queries with their SQL: python -m checks.run [--sf DIR] [pattern ...]"""

from __future__ import annotations

import argparse
import re
import time
from pathlib import Path

import duckdb

from checks.catalog import all_queries, all_sql
from ledgerlark.session import build_session, drop_staged

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*columns, strict=True), key=repr)


def _kind(dtype) -> str:
    text = str(dtype).replace("large_", "")
    return text


def compare(spark, connection, query, sql, folder) -> str:
    got = query(spark, folder).toArrow()
    if sql is None:
        return f"rows {got.num_rows}"
    want = connection.sql(sql).to_arrow_table()
    names, rows = _rows(got)
    want_names, want_rows = _rows(want)
    if names != want_names:
        return f"COLUMNS {names} != {want_names}"
    kinds = {n: (_kind(got.schema.field(n).type), _kind(want.schema.field(n).type)) for n in names}
    wrong = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if wrong:
        return f"TYPES {wrong}"
    if len(rows) != len(want_rows):
        return f"COUNT {len(rows)} != {len(want_rows)}"
    if rows != want_rows:
        off = [(a, b) for a, b in zip(rows, want_rows, strict=True) if a != b]
        return f"VALUES {len(off)} of {len(rows)}, first {off[0]}"
    return f"ok {len(rows)}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("patterns", nargs="*")
    args = parser.parse_args()
    spark = build_session("checks")
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(args.sf) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    sqls = all_sql()
    bad = 0
    for name, query in all_queries().items():
        if args.patterns and not any(re.match(p, name) for p in args.patterns):
            continue
        start = time.time()
        try:
            result = compare(spark, connection, query, sqls.get(name), args.sf)
        except Exception as error:  # the run goes on to the next query
            result = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += not result.startswith(("ok", "rows"))
        print(f"{name:36s} {time.time() - start:6.2f}s {result}", flush=True)
    drop_staged(spark)
    print(f"{bad} wrong")
    return bad


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
