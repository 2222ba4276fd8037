import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from poststream.session import checkpoint_dir, clean_scratch, get_session
    s = get_session("local[4]", app="poststream-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # a private folder only when the session names none
    yield s
    clean_scratch(s)
    s.stop()
