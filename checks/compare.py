"""Run queries and their SQL twins on one folder of tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from checks.oracles import ORACLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from tidemark.session import configure  # noqa: E402


def session(cores: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def rows_of(names, tuples) -> list[tuple]:
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else value
        return value

    return sorted((tuple(cell(r[i]) for i in order) for r in tuples), key=repr)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between the two engines; None if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if not ours:
        return "no rows"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows, " + _first(ours, theirs)
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} and {b}"
    return None


def _first(ours, theirs) -> str:
    mine, other = set(ours) - set(theirs), set(theirs) - set(ours)
    return f"only here {sorted(mine, key=repr)[:2]}, only there {sorted(other, key=repr)[:2]}"


if __name__ == "__main__":
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), database(folder)
    bad = 0
    for query in QUERIES:
        if wanted and query not in wanted:
            continue
        start = time.time()
        try:
            found = "no oracle" if query not in ORACLES else differences(spark, con, query, folder)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:500]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {query:26s} {time.time() - start:6.2f} {found or ''}", flush=True)
    print(f"{bad} bad of {len(QUERIES)}")
