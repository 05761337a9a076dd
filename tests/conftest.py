import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from beneflow.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def silver(spark, folder):
    """Silver of the smallest test tables, stored once."""
    from beneflow.plans import queries
    from beneflow.session import shared_folder

    df = queries.silver(spark, folder)
    path = shared_folder(spark, "silver-fixture")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
