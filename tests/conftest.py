import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from textloom.session import local_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(str(DATA / "documents.parquet"))


@pytest.fixture(scope="session")
def conversations(spark):
    return spark.read.parquet(str(DATA / "conversations.parquet"))
