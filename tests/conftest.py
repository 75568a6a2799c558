import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rankgrad.session import TABLES, local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="rankgrad-test-ck-")
    s = local_session("*", 8, checkpoint_dir=ck, app_name="rankgrad-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    def make(sf):
        import duckdb
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        return con
    return make


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rankgrad-test-")
