import tempfile

import pytest

from martloom.session import get_session


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-martloom-")
    session = get_session(
        "martloom-tests",
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/checkpoint",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, request):
    name = "t_" + request.node.name.replace("[", "_").replace("]", "").replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df, *columns):
    """Sorted tuples of a frame, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
