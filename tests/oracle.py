"""Compare registered queries with their oracle statements.

Run as a script to check queries by name at a scale: ``python -m tests.oracle sf0.01 [name ...]``.
A scale written ``skewed:sf0.01`` checks a copy in folders of several files, in which one
user has a third of the events and one customer a third of the orders.
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

import __spark_entry__ as contract
from tests.helpers import plan

DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def skewed_copy(source: str, target: str, files: int = 4) -> str:
    """Copy the tables the queries read, with one hot key, as folders of several Parquet files."""
    con = duckdb.connect()
    hot = {"events": ("user_id", "event_id"), "orders": ("o_custkey", "o_orderkey")}
    for name in ("events", "orders", "customer", "nation"):
        replaced = ""
        if name in hot:
            key, row = hot[name]
            replaced = f" REPLACE (CASE WHEN {row} % 3 = 0 THEN 7 ELSE {key} END AS {key})"
        con.execute(f"CREATE TABLE {name} AS SELECT *{replaced} FROM '{source}/{name}.parquet'")
        folder = Path(target) / f"{name}.parquet"
        folder.mkdir(parents=True)
        for k in range(files):
            con.execute(f"COPY (SELECT * FROM {name} WHERE rowid % {files} = {k}) TO '{folder}/part-{k}.parquet'")
    return target


def shifted_copy(source: str, target: str) -> str:
    """Copy the tables with a tenth of the events 40 days later and a tenth of the orders 3,000 days later."""
    con = duckdb.connect()
    later = {"events": "CASE WHEN event_id % 10 = 3 THEN ts + INTERVAL 40 DAY ELSE ts END AS ts",
             "orders": "CASE WHEN o_orderkey % 10 = 3 THEN o_orderdate + INTERVAL 3000 DAY ELSE o_orderdate END AS o_orderdate"}
    for name in ("events", "orders", "customer", "nation"):
        replaced = f" REPLACE ({later[name]})" if name in later else ""
        con.execute(f"COPY (SELECT *{replaced} FROM '{source}/{name}.parquet') TO '{target}/{name}.parquet'")
    return target


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path / '*.parquet' if path.is_dir() else path}'")
    return con


def differences(spark, con, name: str, folder: str) -> list[str]:
    """What distinguishes a query's rows from the oracle's, as readable lines; empty when equal."""
    df = contract.queries()[name](spark, folder)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    joins = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin") if w in plan(df)]
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return [f"columns {columns} but oracle has {sorted(names)}"]
    order = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    lines = [f"plan has {w}" for w in joins]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck = {d[0]: str(d[1]) for d in result.description}
    names_of = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    for c in columns:
        if names_of.get(kinds[c]) != duck[c]:
            lines.append(f"type of {c}: {kinds[c]} but oracle has {duck[c]}")
    if got != want:
        lines.append(f"{sum(got.values())} rows, oracle {sum(want.values())}; columns {columns}")
        lines += [f"  only here   {r}" for r in list((got - want))[:3]]
        lines += [f"  only oracle {r}" for r in list((want - got))[:3]]
    if not want:
        lines.append("the oracle returns no rows, so nothing is compared")
    return lines


def main() -> None:
    from beaconry.session import build_session

    scale, *names = sys.argv[1:] or ["sf0.01"]
    folder = f"{DATA}/{scale}"
    if scale.startswith("skewed:"):
        folder = skewed_copy(f"{DATA}/{scale[7:]}", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    bad = 0
    for name in names or sorted(contract.queries()):
        began = time.time()
        try:
            lines = differences(spark, con, name, folder) if name in contract.oracle_sql() else ["no oracle"]
        except Exception as problem:  # report and go on with the next query
            lines = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(lines)
        print(f"{'ok  ' if not lines else 'FAIL'} {name} {time.time() - began:.1f}s", flush=True)
        for line in lines:
            print("    ", line, flush=True)
    print(f"{bad} of {len(names or contract.queries())} differ")


if __name__ == "__main__":
    main()
