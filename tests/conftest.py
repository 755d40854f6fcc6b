import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from guestfold.session import build_session
    # tests only: a scratch warehouse for the bucketed-table test
    s = build_session("local[4]", shuffle_partitions=4, app_name="guestfold-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="guestfold-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
