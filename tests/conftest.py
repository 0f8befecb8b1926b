from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def spark():
    from larkspur.session import session

    os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])
    s = session("tests", "local[8]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="4g", spark_ui_showConsoleProgress="false")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
