import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SALT = "unit-test-salt-1234567890"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "checkpoints"),
        spark__eventLog__enabled="true",
        spark__eventLog__dir=f"file://{base}",
        spark__eventLog__compress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    session.event_log_folder = base
    yield session
    session.stop()


@pytest.fixture
def salt():
    return SALT


@pytest.fixture
def key(spark, salt):
    from tidemark.functions.masking import MaskingKey

    return MaskingKey(spark, salt)


@pytest.fixture
def lake(spark, tmp_path):
    """Makes lakehouses with databases of their own."""
    from tidemark.sources.lakehouse import Lakehouse

    def make(profile):
        return Lakehouse(spark, profile, str(tmp_path), prefix=f"t_{uuid.uuid4().hex[:10]}")

    return make
