import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockloom.session import local_session, stage_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8)
    with stage_folder(session):
        yield session
    session.stop()
