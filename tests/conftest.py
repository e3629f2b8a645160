import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from faresight.session import get_session

    os.environ.setdefault("TZ", "UTC")
    s = get_session("local[*]", 8, app_name="faresight-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="faresight-test-ckpt-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="faresight-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="faresight-test-")
