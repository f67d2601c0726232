import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from touchline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Rows are few here, so compiling code would take most of the time; run_checks.py and the bench compile.
    session = local_session("tests", 8, **{"spark.sql.shuffle.partitions": "4", "spark.sql.codegen.wholeStage": "false"})
    yield session
    session.stop()
