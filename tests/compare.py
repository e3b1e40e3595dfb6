"""Run catalogue queries and their SQL twins side by side and compare sorted values."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return float(v) + 0.0
    return str(v)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(table, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def differences(spark_df, con, sql):
    names, ours = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs_names, theirs = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if names != theirs_names:
        return f"columns {names} against {theirs_names}", len(ours)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} against {len(theirs)}: {set(ours) - set(theirs) and list(set(ours) - set(theirs))[:2]} {list(set(theirs) - set(ours))[:2]}", len(ours)
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else None), len(ours)


def main(folder, only):
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(folder), []
    for name, run in entry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                rows, problem = len(run(spark, folder).collect()), None
            else:
                problem, rows = differences(run(spark, folder), con, sql)
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", -1
            if "-v" in sys.argv:
                traceback.print_exc()
        kind = "oracle" if name in entry.oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {kind} rows={rows} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], [a for a in sys.argv[2:] if a != "-v"])
