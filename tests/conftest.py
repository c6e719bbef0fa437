import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybridge.plans.warehouse import Warehouse  # noqa: E402
from tallybridge.session import build_session, fresh_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark):
    house = Warehouse(spark, fresh_dir(spark, "test"), f"t{uuid.uuid4().hex[:8]}_").create()
    yield house
    house.drop()


@pytest.fixture
def folder(spark):
    return fresh_dir(spark, "test")
