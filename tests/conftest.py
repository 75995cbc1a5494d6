from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salescope.plans.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", shuffle_partitions=8, app_name="salescope-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="salescope-test-ckpt-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture(autouse=True, scope="module")
def nothing_kept(spark):
    """Tables that queries of an earlier module keep don't enter this one's plans."""
    spark.catalog.clearCache()


@pytest.fixture(scope="session")
def crm(spark):
    from tests.fixture_crm import build_model

    return build_model(spark)


def rows(df, *cols):
    """Rows of ``df`` (optionally projected) as sorted tuples."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
