import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from newsrisk.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder for sink tests."""
    import uuid

    from newsrisk.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/pytest-{uuid.uuid4().hex[:10]}"
