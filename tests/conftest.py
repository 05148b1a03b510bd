import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, app="marketweave-tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day():
    return dt.date.fromisoformat


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)


@pytest.fixture(scope="session")
def collect():
    return rows
