"""Run registered queries and their SQL over the same tables and compare the rows.

    python tests/parity.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, build, sql, folder):
    """None when both agree, else a description of the difference."""
    df = build(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = canonical(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    same_kind = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    for column, kind in df.dtypes:
        if same_kind.get(kind, kind) != kinds[column]:
            return f"type of {column}: {kind} != {kinds[column]}"
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    return (f"rows {len(got)} != {len(want)}; only ours {len(extra)}: {sorted(extra)[:2]};"
            f" only sql {len(missing)}: {sorted(missing)[:2]}; columns {sorted(columns)}")


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from citelight.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    con, sql, wanted = connect(folder), oracle_sql(), sys.argv[2:]
    failures = 0
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                verdict = compare(session, con, name, build, sql[name], folder)
                note = f"{con.execute(f'SELECT count(*) FROM ({sql[name]})').fetchall()[0][0]} rows"
            else:
                verdict, note = None, f"no sql, {build(session, folder).count()} rows"
        except Exception as error:  # report and go on with the next query
            verdict, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failures += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.1f}s {note} {verdict or ''}", flush=True)
    print(f"{failures} failures")
