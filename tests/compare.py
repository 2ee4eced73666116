"""Compare a query with its SQL: same columns, same types, same rows in any order.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(con, df, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    names = sorted(df.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    if sorted(duck_types) != names:
        return f"columns {names} / {sorted(duck_types)}"
    for n in names:
        if KINDS.get(spark_types[n], spark_types[n].upper()) != duck_types[n]:
            return f"type of {n}: {spark_types[n]} / {duck_types[n]}"
    order = [list(duck_types).index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    actual = Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if expected != actual:
        return (
            f"{sum(actual.values())} / {sum(expected.values())} rows; {names}; "
            f"only here {list((actual - expected).items())[:2]}; only there {list((expected - actual).items())[:2]}"
        )
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as registered

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), registered.oracle_sql(), 0
    for name, run in registered.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = difference(con, df, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
