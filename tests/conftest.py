import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerkit.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


@pytest.fixture
def texts(spark):
    """A one-column text frame from Python values."""

    def make(values, name="x"):
        return spark.createDataFrame([(v,) for v in values], f"`{name}` string")

    return make


@pytest.fixture
def write_file(tmp_path):
    """Write bytes or text as one file and return its path."""

    def make(content, name="data.csv", encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
        return str(path)

    return make
