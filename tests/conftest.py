import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kintsugi.session import build_session
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.sql.execution.arrow.maxRecordsPerBatch": "64",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kintsugi-tests-")})
    yield s
    from kintsugi.session import release
    release()
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from kintsugi.sources.tables import load_tables
    return load_tables(spark, SF_SMALL)
