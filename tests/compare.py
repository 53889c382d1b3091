"""Runs the catalog's queries against their SQL in DuckDB: python -m tests.compare [sf] [names]."""

import math
import sys
import time
from pathlib import Path

import duckdb

from __spark_entry__ import oracle_sql, queries

TESTDATA = Path("/root/testdata")


def tables(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS FROM read_parquet('{path}')")
    return con


def rows_of_sql(con, sql):
    found = con.execute(sql)
    return [c[0] for c in found.description], found.fetchall()


def normal(columns, rows):
    """Rows as a sorted list with columns in name order; NaN made comparable."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    values = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(values, key=repr)


def compare(spark, con, sf_dir, name):
    df = queries()[name](spark, str(sf_dir))
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    theirs = normal(*rows_of_sql(con, oracle_sql()[name]))
    return ours, theirs


def main():
    from tests.conftest import new_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(oracle_sql())
    spark = new_session()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = TESTDATA / f"sf{sf}"
    con = tables(sf_dir)
    for name in names:
        begun = time.time()
        try:
            ours, theirs = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            print(f"{name:32} ERROR {str(error)[:1500]}", flush=True)
            continue
        verdict = "ok" if ours == theirs else "DIFFERS"
        print(f"{name:32} {verdict} {len(ours[1])} {len(theirs[1])} {time.time() - begun:.1f}s", flush=True)
        if ours != theirs:
            print("  ours  ", ours[0], [r for r in ours[1] if r not in set(theirs[1])][:3])
            print("  theirs", theirs[0], [r for r in theirs[1] if r not in set(ours[1])][:3])


if __name__ == "__main__":
    main()
