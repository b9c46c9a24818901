import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import get_session
    s = get_session("cohortkit-tests", cores="*", shuffle_partitions=8)
    yield s


def ts(s: str):
    import datetime as dt
    return dt.datetime.fromisoformat(s)
