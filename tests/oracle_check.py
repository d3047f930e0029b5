"""Compare queries with their SQL twins: ``python tests/oracle_check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
}


def differences(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, columns and types."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    result = con.execute(sql)
    kinds = {c[0]: str(c[1]) for c in result.description}
    want_names = [c[0] for c in result.description]
    if sorted(want_names) != names:
        return f"columns {names} != {sorted(want_names)}"
    place = [want_names.index(n) for n in names]
    want = [tuple(r[i] for i in place) for r in result.fetchall()]
    mine = {f.name: _KINDS.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    got.sort(key=key)
    want.sort(key=key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first extra {next(iter(set(got) ^ set(want)), None)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{names}\n    got  {a}\n    want {b}"
    off = {n: (mine[n], kinds[n]) for n in names if mine[n] != kinds[n].upper().replace("NUMBER", mine[n])}
    off = {n: p for n, p in off.items() if p[1] not in ("STRING", "NUMBER", "bool")}
    return f"types differ: {off}" if off else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    sql, failed = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            bad = differences(spark, con, query, sql[name], sf_dir) if name in sql else (
                None if query(spark, sf_dir).count() >= 0 else "no rows"
            )
        except Exception as exc:  # noqa: BLE001 - reported per query
            bad = f"{type(exc).__name__}: {str(exc)[:900]}"
        failed += bad is not None
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.time() - start:.1f}s {bad or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
