import os

import pytest

from tests.compare import session

DATA = os.environ.get("CASELAKE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("8")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA
