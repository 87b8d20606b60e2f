"""Compare registered queries with their SQL: ``python tests/compare.py <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

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


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=lambda r: [repr(v) for v in r])


def difference(df, con, sql: str) -> str | None:
    """None when rows, names and value types agree, else what differs."""
    names = sorted(df.columns)
    got = _sorted(df.select(*names).collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    order = [columns.index(n) for n in names]
    want = _sorted([tuple(r[i] for i in order) for r in cursor.fetchall()])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types of {a!r} != {b!r}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from rillflow.session import build_session

    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            found = difference(run(spark, sf_dir), con, sqls[name]) if name in sqls else "no SQL"
        except Exception as err:  # keep going, report at the end
            found = f"{type(err).__name__}: {str(err)[:600]}"
        bad += found is not None
        print(f"{name:36s} {time.time() - began:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
