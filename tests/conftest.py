import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from forgeline.session import local_session

    s = local_session(4, 4, app_name="forgeline-tests")
    yield s
    s.stop()


@pytest.fixture()
def lake(tmp_path):
    from forgeline.config import Lake

    return Lake(root=str(tmp_path / "lake"))


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, *cols):
    """Rows as tuples, sorted (None first)."""
    data = [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, str(v)) for v in t))
