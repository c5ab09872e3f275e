import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from ticketloom.session import build_session

    return build_session(3, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC"})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
