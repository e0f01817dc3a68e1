"""Compare registered queries with their SQL on DuckDB: ``python check.py [sf] [name-prefix ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from sparkloom import get_session
from sparkloom.catalog import ORACLES, QUERIES, load_all
from sparkloom.sources.tables import SCHEMAS

KINDS = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "integer": "int", "hugeint": "huge",
         "double": "float", "float": "float", "string": "str", "varchar": "str", "boolean": "bool",
         "date": "date", "timestamp": "ts", "timestamp_ntz": "ts"}


def duck(folder: str):
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v) if v != int(v) or abs(v) > 1e15 else str(int(v))
    return str(v)


def compare(df, con, name: str) -> str:
    cols = sorted(df.columns)
    got = sorted(tuple(cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if name not in ORACLES:
        return f"rows {len(got)}" if got else "EMPTY"
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    types = {d[0]: KINDS.get(str(d[1]).lower().split("(")[0], str(d[1])) for d in rel.description}
    if sorted(names) != cols:
        return f"COLUMNS {sorted(names)} vs {cols}"
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(cell(r[i]) for i in idx) for r in rel.fetchall())
    if not got:
        return "EMPTY"
    if len(got) != len(want):
        return f"COUNT spark {len(got)} sql {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"VALUES {len(bad)} of {len(got)} e.g. {cols}: spark {bad[0][0]} sql {bad[0][1]}"
    off = {c: (t, types[c]) for c, t in df.dtypes if KINDS.get(t, t) != types[c]}
    return f"TYPES {off}" if off else f"ok {len(got)}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    folder = f"/root/testdata/sf{sf}"
    load_all()
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                       "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    assert Path(folder).exists(), folder
    con, failed, t_all = duck(folder), 0, time.time()
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            result = compare(QUERIES[name](spark, folder), con, name)
        except Exception as error:  # report and go on to the next query
            result = "ERROR " + str(error)[:700]
        good = result.startswith(("ok", "rows"))
        failed += not good
        print(f"{'  ' if good else '!!'} {name} {time.time() - start:.2f}s {result}", flush=True)
    print(f"{failed} failed, {time.time() - t_all:.0f}s")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
