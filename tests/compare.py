"""Compare a registered query with its SQL on DuckDB: names, types, and rows as a multiset."""

from __future__ import annotations

import glob
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


counts: dict[str, int] = {}


def compare(spark, con, name, query, sql, sf_dir):
    """A list of differences, empty if the results agree."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    counts[name] = got.total()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for col, kind in df.dtypes:
        if TYPES.get(kind, kind) != types[col]:
            problems.append(f"type of {col}: {kind} != {types[col]}")
    if got != want:
        problems.append(
            f"{got.total()} rows != {want.total()} rows; only here {list((got - want))[:3]}; "
            f"only in SQL {list((want - got))[:3]}"
        )
    return problems


def main(sf_dir, only):
    import __spark_entry__ as entry
    from rainledger.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problems = compare(spark, con, name, query, sqls[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {counts.get(name)} rows {time.time() - start:.1f}s", *problems, sep="\n    ", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
