import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyfold.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[8]",
        spark__checkpoint__dir=f"file://{shared}",
        spark__sql__warehouse__dir=f"file://{shared}/warehouse",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        # Generated code that does not compile is an error, not a silent slow path.
        spark__sql__codegen__fallback="false",
        spark__sql__maxMetadataStringLength="2000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not Path(TESTDATA).exists():
        pytest.skip("driver tables are not here")
    return TESTDATA


@pytest.fixture
def plan_of():
    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
