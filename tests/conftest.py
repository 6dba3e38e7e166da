from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fieldloom import session

    made = session.build("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__host="127.0.0.1", spark__driver__memory="4g", spark__ui__showConsoleProgress="false", spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")))
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
