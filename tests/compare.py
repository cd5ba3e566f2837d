"""Run registered queries next to their SQL twins and compare the rows.

    python tests/compare.py [sf folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, list):
        return tuple(value)
    return value


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(normal(r[i]) for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], rows


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(normal(v) for v in r) for r in df.select(*names).collect()]


def differences(spark, con, folder: str, fn, sql: str) -> tuple[str, int]:
    got_names, got = spark_rows(fn(spark, folder))
    want_names, want = oracle_rows(con, sql)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", len(got)
    a, b = Counter(got), Counter(want)
    if a == b:
        return "", len(got)
    extra, missing = list((a - b).elements()), list((b - a).elements())
    show = "\n   ".join([f"spark {len(got)} rows, oracle {len(want)}; {len(extra)} extra, {len(missing)} missing",
                         *[f"+ {r}"[:600] for r in sorted(extra, key=str)[:3]],
                         *[f"- {r}"[:600] for r in sorted(missing, key=str)[:3]]])
    return show, len(got)


def main() -> int:
    from peerglass.plans import ORACLES, QUERIES
    from peerglass.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    wanted = args or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            if name in ORACLES:
                diff, n = differences(spark, con, folder, QUERIES[name], ORACLES[name])
            else:
                diff, n = "", QUERIES[name](spark, folder).count()
        except Exception as error:  # report every query, not only the first that fails
            diff, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name}: {n} rows, {time.time() - start:.1f}s {diff}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
