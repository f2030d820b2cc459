import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def layout(spark, request):
    """A layout of its own per test, with every database in shared scratch."""
    from tidemark.plans.layout import Layout
    from tidemark.session import scratch_dir
    from tidemark.sources import tables

    place = Layout("t" + scratch_dir(spark).rsplit("/", 1)[1][:12])
    for stage in Layout.STAGES:
        tables.ensure_database(spark, place.database(stage), scratch_dir(spark))
    return place
