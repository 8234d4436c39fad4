import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.environ.get("PYTHONPATH", "")])

DATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from lodestone.session import get_spark

    s = get_spark("tests", 4, **{"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    d = f"{DATA}/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    return d


@pytest.fixture(scope="session")
def records_schema():
    return "_idx bigint, id string, instruction string, context string, response string, category string"
