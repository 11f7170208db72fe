"""Run registered queries next to their SQL counterparts and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return int(value) if value.is_integer() else repr(value)
    return value


def row_counts(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else a short description."""
    table = run(spark, sf_dir).toArrow()
    mine = row_counts(table.column_names, zip(*[c.to_pylist() for c in table.columns]))
    theirs_table = con.execute(sql).to_arrow_table()
    if sorted(table.column_names) != sorted(theirs_table.column_names):
        return f"columns {sorted(table.column_names)} != {sorted(theirs_table.column_names)}"
    theirs = row_counts(theirs_table.column_names, zip(*[c.to_pylist() for c in theirs_table.columns]))
    if mine == theirs:
        return None if mine else "both empty"
    return (
        f"{sum(mine.values())} rows vs {sum(theirs.values())}; only here {list((mine - theirs).items())[:3]}; "
        f"only there {list((theirs - mine).items())[:3]}"
    )


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from locusflow.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    chosen = sys.argv[2:]
    spark, con, sqls, failed = local_session("check"), connect(sf_dir), oracle_sql(), []
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            problem = difference(spark, con, run, sqls[name], sf_dir) if name in sqls else None
            if name not in sqls:
                print(f"     {name}: {run(spark, sf_dir).count()} rows, no SQL")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed or "none")


if __name__ == "__main__":
    main()
