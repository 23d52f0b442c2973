import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="ledgerlake-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="ledgerlake-test-warehouse-")
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="ledgerlake-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from ledgerlake.sources.tables import TEST_TABLES
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
