import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pumpline.session import build_session

    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pumpline-test-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
