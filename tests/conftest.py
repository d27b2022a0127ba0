import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from daystream.session import get_spark
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_spark("local[4]", shuffle_partitions=4, app_name="daystream-tests",
                  checkpoint_dir=ckpt)
    yield s
    s.stop()
