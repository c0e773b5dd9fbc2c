from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hazardmarts import session


def local_session(cores: int = 8, **extra: str):
    spark = session.build(
        "hazardmarts-tests",
        master=f"local[{cores}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="hazardmarts-"),
        **extra,
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session_ = local_session()
    yield session_
    session_.stop()
