import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from pitchflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4, app="pitchflow-tests")
    session.sparkContext.setLogLevel("ERROR")
    # Plan tests read whole plans.
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    session.conf.set("spark.sql.debug.maxToStringFields", "1000")
    yield session
    session.stop()
