import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from changelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("changelake-tests", cores=8, root=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
