"""Run queries and their checking SQL side by side: python tests/compare.py <sf> [names…]."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from maskloom.plans import catalogue  # noqa: E402
from maskloom.plans.common import TABLES  # noqa: E402
from maskloom.session import local_session  # noqa: E402

KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> list[str]:
    """Differences between a query and its check; empty when they agree."""
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted(map(repr, (tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())))
    if name not in catalogue.ORACLES:
        return []
    rel = con.sql(catalogue.ORACLES[name])
    if sorted(rel.columns) != columns:
        return [f"columns {columns} against {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    out = [
        f"type of {c}: {df.schema[c].dataType.simpleString()} against {kinds[c]}"
        for c in columns if KINDS.get(kinds[c]) != df.schema[c].dataType.simpleString()
    ]
    listed = ", ".join(f'"{c}"' for c in columns)
    other = sorted(map(repr, con.sql(f"SELECT {listed} FROM ({catalogue.ORACLES[name]}) AS q").fetchall()))
    if not rows:
        out.append("no rows at all")
    if rows != other:
        mine, theirs = set(rows) - set(other), set(other) - set(rows)
        out.append(f"{len(rows)} rows against {len(other)}; only here {sorted(mine)[:3]}; only there {sorted(theirs)[:3]}")
    return out


def main() -> None:
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or catalogue.QUERIES:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problems = [str(error)[:600]]
        bad += bool(problems)
        checked = "" if name in catalogue.ORACLES else " (rows only)"
        print(f"{'FAIL' if problems else 'ok  '} {name}{checked} {time.time() - start:.1f}s", *[p[:900] for p in problems], sep="\n    " if problems else " ")
    print(f"{bad} of {len(sys.argv[2:] or catalogue.QUERIES)} differ")


if __name__ == "__main__":
    main()
