"""Run registered queries beside their SQL checks: ``python -m tests.oracle [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA / sf / name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(normal(row[k]) for k in order) for row in rows]
    return [columns[k] for k in order], sorted(out, key=repr)


def difference(spark, con, sf: str, name: str, build, sql: str | None) -> tuple[str | None, int]:
    df = build(spark, str(DATA / sf))
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return (None if rows else "no rows"), len(rows)
    got = sorted_rows(df.columns, rows)
    result = con.execute(sql)
    want = sorted_rows([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(rows)
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}", len(rows)
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else None), len(rows)


def main(names: list[str]) -> None:
    import __spark_entry__ as e
    from barloom.session import build_session
    sf = "sf0.01"
    if names and names[0].startswith("sf"):
        sf = names.pop(0)
    spark = build_session("oracle", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.log.level": "ERROR"})
    con, sqls, failed = connect(sf), e.oracle_sql(), 0
    for name, build in e.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            problem, n = difference(spark, con, sf, name, build, sqls.get(name))
        except Exception as exc:  # report and go on
            problem, n = f"{type(exc).__name__}: {str(exc)[:1500]}", -1
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} rows={n} {time.time() - start:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"failed {failed}")


if __name__ == "__main__":
    main(sys.argv[1:])
