import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newsloom.session import build_session

    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("local[8]", "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
