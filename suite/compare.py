"""Run registered queries on Spark and DuckDB over the same folder and compare all rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from suite.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else repr(v)
    return repr(v)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


SIZES: dict[str, int] = {}


def difference(spark, name: str, sf_dir: str, con=None) -> str | None:
    """None when both sides agree, else what differs."""
    from suite import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    SIZES[name] = len(mine)
    if name not in ORACLES:
        return None
    result = (con or duck(sf_dir)).execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if mine == theirs:
        return None
    extra = [r for r in mine if r not in set(theirs)][:2]
    missing = [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} and {len(theirs)} rows; only in Spark {extra}; only in DuckDB {missing}"


def main() -> None:
    from sqlloom.session import local_session
    from suite import QUERIES

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), duck(sf_dir)
    bad = 0
    for name in only or QUERIES:
        start = time.time()
        try:
            found = difference(spark, name, sf_dir, con)
        except Exception as e:  # noqa: BLE001 - report and go on
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {SIZES.get(name, 0):7d} rows {'ok' if found is None else 'DIFFERS ' + found}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
