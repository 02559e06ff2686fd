import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geomosaic.session import close_work, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("4", "tests", **{"spark.checkpoint.dir": str(shared)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    close_work(session)
    assert not list((shared / "geomosaic").glob("*"))
    session.stop()
