import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from judicata.session import get_session
    wh = tempfile.mkdtemp(prefix="judicata-wh-")
    s = get_session("local[*]", app="judicata-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()
