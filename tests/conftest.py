import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabelion.session import build_session, scratch_path  # noqa: E402
from tabelion.sources import fs  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tabelion-tests", partitions=8)
    yield s
    s.stop()


@pytest.fixture
def folder(spark):
    """A fresh folder under the session's scratch root; returns (uri, local_path)."""
    uri = scratch_path(spark, "tests", uuid.uuid4().hex)
    fs.makedirs(uri)
    return uri, fs.resolve(uri)[1]


def write_bytes(local_dir: str, name: str, data: bytes) -> str:
    path = os.path.join(local_dir, name)
    with open(path, "wb") as f:
        f.write(data)
    return path
