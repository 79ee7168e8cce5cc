import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tallyloom-tests", "local[8]", 8, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyloom-tests-"), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
