from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.001"
DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    from occrisk.session import local_session

    session = local_session(4, "4g", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def layers(spark):
    from occrisk.plans.staging import staging_layer
    from occrisk.sources.adapter import raw_layer

    raw = raw_layer(spark, SF_DIR)
    return raw, staging_layer(raw)


def rows(df) -> list[tuple]:
    """Rows as tuples in a stable order, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
