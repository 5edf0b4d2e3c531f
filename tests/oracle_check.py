"""Run queries next to their oracles: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402
from strata.workload.oracles import all_oracles  # noqa: E402
from strata.workload.queries import all_queries  # noqa: E402

TABLES = "events orders lineitem".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def difference(spark, con, sf_dir, name):
    """None when query and oracle agree, else what differs."""
    df = all_queries()[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if name not in all_oracles():
        return None if got else "no rows"
    answer = con.execute(all_oracles()[name])
    names = [column[0] for column in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    want = _rows(names, answer.fetchall())
    if not want:
        return "the oracle has no rows"
    kinds = [{type(v) for v in column if v is not None} for column in zip(*got)]
    expected = [{type(v) for v in column if v is not None} for column in zip(*want)]
    if got == want and kinds == expected:
        return None
    wrong = next(((g, w) for g, w in zip(got, want) if g != w), None)
    return f"{len(got)} rows, expected {len(want)}; first difference {wrong}; types {kinds} {expected}"


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "oracle-check",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), []
    for query_name in sys.argv[2:] or all_queries():
        started = time.time()
        try:
            problem = difference(session, connection, folder, query_name)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {query_name} {time.time() - started:.1f}s")
        if problem:
            failed.append(query_name)
            print("     ", problem[:3000])
    print("failed:", failed)
