import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    import math

    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def same_rows(df, con, sql) -> None:
    """df's rows and DuckDB's, by column name and whatever order."""
    columns = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    run = con.execute(sql)
    names = [d[0] for d in run.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in run.fetchall())
    assert mine == theirs
