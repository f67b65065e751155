"""Compare every registered query with its SQL twin; run as a script.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(
        ordered, key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


def differences(spark_df, con, sql: str, limit: int = 3) -> list[str]:
    ours = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"rows {len(ours[1])} != {len(theirs[1])}"]
    bad = []
    for a, b in zip(ours[1], theirs[1]):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float)
                       and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ) and [type(x) for x in a] == [type(y) for y in b]
        if not same:
            bad.append(f"{a} != {b}")
            if len(bad) == limit:
                break
    return bad


def main() -> None:
    from tests.conftest import session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(sf_dir)
    oracles = entry.oracle_sql()
    chosen = sys.argv[2:] or list(oracles)
    failed = 0
    for name in chosen:
        began = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            bad = differences(df, con, oracles[name])
        except Exception as error:
            bad = [str(error)[:600]]
        failed += bool(bad)
        took = time.time() - began
        print(f"{'FAIL' if bad else 'ok  '} {name} {took:.2f}s", *bad, flush=True)
    print(f"{failed} of {len(chosen)} differ")
    spark.stop()


if __name__ == "__main__":
    main()
