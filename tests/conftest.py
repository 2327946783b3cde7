import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from benchloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = build_session(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """The first row of a frame made of one text cell per name."""

    def frame(**cells):
        ddl = ", ".join(f"{name} STRING" for name in cells)
        return spark.createDataFrame([tuple(cells.values())], ddl)

    return frame
