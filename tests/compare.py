"""Run named queries in Spark and their SQL twins in DuckDB on the same files and compare.

``python -m tests.compare /root/testdata/sf0.01 [name …]``
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return con


def family(kind: str) -> str:
    kind = kind.lower()
    for name, kinds in {
        "int": ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"),
        "float": ("float", "double"),
        "text": ("string", "varchar"),
        "time": ("timestamp", "timestamp_ntz", "timestamp_us"),
    }.items():
        if kind in kinds:
            return name
    return kind


def differences(spark: SparkSession, con, sf_dir: str, run, sql: str) -> tuple[str | None, int]:
    """What differs (None when nothing does), and the number of rows."""
    df = run(spark, sf_dir)
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} != {sorted(rel.columns)}", 0
    kinds = {n: family(k) for n, k in df.dtypes}
    duck_kinds = {n: family(str(k)) for n, k in zip(rel.columns, rel.types)}
    if kinds != duck_kinds:
        return f"types {set(kinds.items()) ^ set(duck_kinds.items())}", 0
    ours = Counter(tuple(map(repr, row)) for row in df.select(*names).collect())
    columns = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(
        tuple(map(repr, row)) for row in con.sql(f"SELECT {columns} FROM ({sql})").fetchall()
    )
    n = sum(ours.values())
    if ours != theirs:
        only = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        return f"{sum((ours - theirs).values())} of {n} rows differ, {sum(theirs.values())} expected: {only}", n
    return None, n


def main() -> None:
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("SESSION_ZONE", "UTC"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, runs, sqls = duck(sf_dir), entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(runs) - set(sqls)), "without query:", sorted(set(sqls) - set(runs)))
    bad = 0
    for name in names or [n for n in runs if n in sqls]:
        start = time.time()
        try:
            problem, n = differences(spark, con, sf_dir, runs[name], sqls[name])
        except Exception as err:  # report and go on with the next query
            problem, n = f"{type(err).__name__}: {str(err)[:900]}", 0
        bad += problem is not None
        print(f"{name:28} {n:7} rows {time.time() - start:6.2f} s  {problem or 'ok'}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
