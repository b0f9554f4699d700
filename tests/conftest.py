import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from galepost.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-")
    session = local_session(
        8,
        4,
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
        },
    )
    yield session
    session.stop()
