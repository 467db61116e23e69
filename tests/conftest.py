import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyforge.session import get_spark

    session = get_spark(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g", spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not Path(SMALL).exists():
        pytest.skip("the driver's tables aren't here")
    return SMALL
