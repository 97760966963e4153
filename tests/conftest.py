import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starmart.session import build_session

    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a small table: rows(schema, tuples...)."""
    def build(schema, *values):
        return spark.createDataFrame(list(values), schema)
    return build


def values(df, *order):
    """Rows as sorted tuples, NULL last."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is None, v) for v in r])
