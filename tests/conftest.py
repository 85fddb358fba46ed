from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kinbridge import workspace  # noqa: E402
from kinbridge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Few partitions and few buckets of the key index: the tables are tiny.
    session = local_session(
        "tests", cores=8, spark__sql__shuffle__partitions="4", spark__kinbridge__keyBuckets="8"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A fresh path below the shared working folder."""
    return workspace.new_folder(spark, "test")
