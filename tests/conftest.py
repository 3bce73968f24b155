from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from subsmart.session import local_session

    session = local_session("4", app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
