"""Run registered queries beside their SQL and compare all values: python -m tests.harness [sf] [names or prefixes]."""

from __future__ import annotations

import math
import sys
import time

DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(value) + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_plain(v) for v in row) for row in zip(*columns))


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[str, float]:
    start = time.time()
    out = fn(spark, sf_dir)
    mine = out.toArrow()
    took = time.time() - start
    if sql is None:
        return (f"rows {mine.num_rows}" if mine.num_rows else "NO ROWS"), took
    theirs = con.execute(sql).to_arrow_table()
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return f"COLUMNS {sorted(mine.column_names)} {sorted(theirs.column_names)}", took
    kinds = lambda t: {n: _kind(t.schema.field(n).type) for n in t.column_names}
    if kinds(mine) != kinds(theirs):
        diff = {n: (kinds(mine)[n], kinds(theirs)[n]) for n in kinds(mine) if kinds(mine)[n] != kinds(theirs)[n]}
        return f"TYPES {diff}", took
    a, b = rows_of(mine), rows_of(theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"DIFFERS {len(a)} vs {len(b)} rows, {only_a} | {only_b}", took
    return f"ok {len(a)}", took


def _kind(t) -> str:
    return str(t).replace("large_string", "string")


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from inkprint.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", 8, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            result, took = compare(spark, con, name, fn, entry.oracle_sql().get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - a broken query is reported, the rest still run
            result, took = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0.0
        good = result.startswith(("ok", "rows"))
        bad += not good
        print(f"{'   ' if good else '!! '}{name:34s} {took:6.2f}s {result}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
