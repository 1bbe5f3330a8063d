import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import session

    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="3g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('ckpt')}", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("wh")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
