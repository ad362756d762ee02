from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from siftline.schemas import RECORD  # noqa: E402
from siftline.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        shuffle_partitions=4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "6g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """A record log from ``(partition, offset, key[, value])`` tuples; the value defaults to the key."""

    def make(*rows):
        full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else r[2]) for r in rows]
        return spark.createDataFrame(full, RECORD)

    return make


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "root")
