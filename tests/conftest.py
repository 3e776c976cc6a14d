import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fundpanel.session import local_session  # noqa: E402
from fundpanel.sources import states as state_table  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def states(spark):
    return state_table(spark)


@pytest.fixture
def grid(spark):
    """Grid (file, row_no, cells, year) from lists of cells per file."""

    def make(files: dict, years: dict | None = None):
        rows = [(f, i, [None if c == "" else c for c in cells], (years or {}).get(f))
                for f, sheet in files.items() for i, cells in enumerate(sheet, 1)]
        return spark.createDataFrame(rows, "file string, row_no bigint, cells array<string>, year int")

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
