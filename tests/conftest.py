import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from creditlake.settings import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows_of():
    def rows(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return rows


@pytest.fixture(scope="session")
def same_rows():
    def same(a, b):
        key = lambda r: tuple((v is None, str(v)) for v in r)
        return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.select(a.columns).collect()), key=key)

    return same
