import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickmart.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="tickmart-tests", shuffle_partitions=4)
    yield s


def D(x) -> Decimal:
    return Decimal(str(x))


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def d(s: str) -> date:
    return date.fromisoformat(s)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
