import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    if not Path(FOLDER).exists():
        pytest.skip("test tables are not here")
    return FOLDER
