"""Compares registered queries with their SQL twins on the same tables."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, sql: str, con) -> list[str]:
    """What differs, as lines; empty when both sides agree in columns, types' families and rows."""
    got_names, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_names, want = _sorted_rows([c[0] for c in rel.description], rel.fetchall())
    out = []
    if got_names != want_names:
        out.append(f"columns {got_names} != {want_names}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if not out and got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        out.append(f"{len(bad)} rows differ, first: {str(bad[0])[:600]}")
    kinds = {tuple(type(v) for v in r if v is not None) for r in got[:50]} ^ {tuple(type(v) for v in r if v is not None) for r in want[:50]}
    if not out and kinds:
        out.append(f"value types differ: {kinds}")
    return out


def main() -> None:
    from tests.session import make_session

    from tidesift.plans.catalog import REGISTRY

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name, entry in REGISTRY.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if entry.sql:
                found = differences(entry.run(spark, sf_dir), entry.sql, con)
                note = "ok" if not found else "; ".join(found)
            else:
                rows = entry.run(spark, sf_dir).collect()
                found = [] if rows else ["no rows"]
                note = f"rows {len(rows)} {str(rows[0])[:150] if rows else ''}"
        except Exception as error:  # noqa: BLE001
            found = [str(error)]
            note = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:32s} {time.time() - start:6.1f}s  {'' if note == 'ok' else note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
