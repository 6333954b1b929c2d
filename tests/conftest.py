from __future__ import annotations

import os
import tempfile

import duckdb
import pytest

from sendero.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    session = build_session("sendero-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "1000",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sendero-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
