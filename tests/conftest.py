from __future__ import annotations

import os

import duckdb
import pytest

from tests.support import duck_tables, local_spark


@pytest.fixture(scope="session")
def spark():
    return local_spark()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("LAKEBOOK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def duck(sf_dir):
    return duck_tables(duckdb.connect(), sf_dir)
