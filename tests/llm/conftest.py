from __future__ import annotations

import glob
import os

import duckdb
import pytest


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="session")
def texts(duck):
    """doc_id and text of the test documents."""
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
