"""A session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from tideframe.session import session

    spark = session("tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
