"""Compare registered queries with their SQL in DuckDB: names, types, row counts and values.

Run directly:  python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float):
        return repr(value)
    return repr(value) if not isinstance(value, (str, int, bool, type(None))) else value


def _sorted_rows(rows, order):
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple(str(v) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rows = [tuple(r) for r in df.collect()]
    con.execute(sql)
    names = [d[0] for d in con.description]
    expected = con.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    order = sorted(df.columns)
    ours = _sorted_rows(rows, [df.columns.index(c) for c in order])
    theirs = _sorted_rows(expected, [names.index(c) for c in order])
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{order}\n   spark  {a}\n   duckdb {b}"
    kinds = dict(zip(names, [str(t[1]) for t in con.execute(f"DESCRIBE {sql}").fetchall()]))
    simple = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
              "boolean": "BOOLEAN", "date": "DATE"}
    types = {c: (simple.get(t, t), kinds[c]) for c, t in df.dtypes if simple.get(t, t) != kinds[c]}
    return f"types {types}" if types else None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from strata import session

    spark = session.build("check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                  "spark.driver.memory": "8g",
                                                  "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                note = "ok" if problem is None else "DIFF " + problem
            else:
                note = f"rows only: {df.count()}"
        except Exception as failure:  # noqa: BLE001 - report and go on with the next query
            note = "ERROR " + str(failure)[:600]
        bad += not note.startswith(("ok", "rows only"))
        print(f"{name:34s} {time.time() - began:6.2f}s {note}", flush=True)
    print("failing:", bad)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    sys.exit(min(main(folder, arguments), 1))
