import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from readloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as sorted tuples."""

    def collect(df, *cols):
        out = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in out.collect()), key=repr)

    return collect
