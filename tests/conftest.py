import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from ledgerlake.session import get_session
    s = get_session("local[4]", 4, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ll-wh-")})
    yield s
    s.stop()
