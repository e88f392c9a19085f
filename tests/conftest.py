from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starquill.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        # tiny inputs: compiling the generated code would take most of the time
        "spark.sql.codegen.wholeStage": os.environ.get("TEST_CODEGEN", "false")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rental(spark):
    """The tables of the rental schema with a few rows each; see ``rental_rows``."""
    from rental_rows import ROWS
    from starquill.sources.inline import values
    from starquill.sources.tables import RENTAL_SCHEMAS

    class Tables(dict):
        __getattr__ = dict.__getitem__

    return Tables({name: values(spark, rows, RENTAL_SCHEMAS[name])
                   for name, rows in ROWS.items()})


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
