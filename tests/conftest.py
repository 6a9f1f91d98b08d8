import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.session import session  # noqa: E402
from tickloom.plans.stage import clean  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    clean(s)
    s.stop()
