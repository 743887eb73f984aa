import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": str(scratch),
        "spark.sql.warehouse.dir": str(scratch / "warehouse"),
    })
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a result as sorted tuples."""
    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return of
