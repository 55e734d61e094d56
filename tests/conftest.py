import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from visitlens.session import build_session, remove_intermediate  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = build_session(8, "tests", **conf)
    yield session
    remove_intermediate(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
