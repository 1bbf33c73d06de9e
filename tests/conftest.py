import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.local.dir", str(base / "local")).config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(base / "shared")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _rows(columns, rows):
    def text(x):
        if x is None or x != x:
            return "null"
        if isinstance(x, bool):
            return str(x)
        return repr(float(x) + 0.0) if isinstance(x, (int, float)) else str(x)

    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(text(r[k]) for k in order) for r in rows)


@pytest.fixture(scope="session")
def same_as_sql(spark, duck):
    def check(query, sql):
        got = query(spark, SF)
        want = duck.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        assert _rows(got.columns, got.collect()) == _rows(want.columns, want.fetchall())

    return check
