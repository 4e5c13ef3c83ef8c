from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wardline.session import local_session

    s = local_session("*", app="wardline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def hospital(spark):
    from tests.hospital_fixture import hospital_tables

    return hospital_tables(spark)
