import os
import sys
import tempfile

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(TESTS))
# Python workers import the package and test helpers too.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(TESTS), TESTS, os.environ.get("PYTHONPATH", "")])

from tidegauge.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tidegauge-tests-")
    session = build_session("tests", "local[8]", **{
        "spark_sql_shuffle_partitions": "4", "spark_ui_enabled": "false",
        "spark_driver_memory": "6g", "spark_checkpoint_dir": folder,
        "spark_sql_warehouse_dir": f"{folder}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shared(spark, tmp_path):
    return str(tmp_path)
