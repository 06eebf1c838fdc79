import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session
    scratch = tempfile.mkdtemp(prefix="millrace-test-")
    s = build_session("local[4]", app="millrace-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="millrace-case-")
