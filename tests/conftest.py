import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from commitfold import session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    built = session.build(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def folder():
    if not DATA.exists():
        pytest.skip("test data not present")
    return str(DATA)
