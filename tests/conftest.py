import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rulemill.session import get_spark
    base = tmp_path_factory.mktemp("spark")
    session = get_spark("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1",
        "spark.checkpoint.dir": str(base / "checkpoints"), "spark.sql.warehouse.dir": str(base / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *cols):
    """Sorted tuples of the given columns."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
