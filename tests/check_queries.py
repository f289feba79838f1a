"""Run registered queries beside their SQL: python tests/check_queries.py [-s sf] [name ...]"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (f"{v + 0.0:.9g}")
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def type_class(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "int", "integer", "smallint", "tinyint"):
        return "int" if t != "bigint" else "bigint"
    if t in ("double",):
        return "double"
    if t in ("string", "varchar"):
        return "text"
    if t in ("timestamp_ntz", "timestamp"):
        return "timestamp"
    if t.startswith("array<") or t.endswith("[]"):
        return "list"
    return t


def compare(df, con, sql: str) -> str | None:
    """None where both give the same columns, types and rows, else what differs."""
    columns = sorted(df.columns)
    got = sorted((repr([norm(r[c]) for c in columns]) for r in df.collect()))
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    rows = res.fetchall()
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = sorted(repr([norm(r[i]) for i in order]) for r in rows)
    types = {n: t for n, t, *_ in con.execute(f"describe {sql}").fetchall()}
    for f in df.schema.fields:
        a, b = type_class(f.dataType.simpleString()), type_class(types[f.name])
        if a != b:
            return f"type of {f.name}: {a} != {b}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        miss = [w for w in want if w not in set(got)][:2]
        extra = [g for g in got if g not in set(want)][:2]
        return f"values differ ({len(got)} rows): want {miss} got {extra}"
    return f"OK {len(got)} rows" if got else "OK but EMPTY"


def main(argv: list[str]) -> int:
    from weirworks.session import build_session

    sf = "sf0.01"
    if argv[:1] == ["-s"]:
        sf, argv = argv[1], argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    con = duck(f"{DATA}/{sf}")
    bad = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            df = fn(spark, f"{DATA}/{sf}")
            if name in sqls:
                verdict = compare(df, con, sqls[name])
            else:
                verdict = f"OK (no SQL) {len(df.collect())} rows"
        except Exception as e:  # noqa: BLE001
            verdict = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        bad += not verdict.startswith("OK")
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
