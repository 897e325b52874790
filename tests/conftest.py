import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rainledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "rainledger-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rainledger-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rainledger-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
