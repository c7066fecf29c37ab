import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from cotejo.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate column expressions on one column ``c`` of given texts."""

    def run(items, column, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, c {kind}")
        return [r[0] for r in df.orderBy("i").select(column.alias("x")).collect()]

    return run
