import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidegrid.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def lake(spark, tmp_path):
    from tidegrid.operators.tables import Lakehouse

    return Lakehouse(spark, str(tmp_path / "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(autouse=True)
def no_views_left(request):
    """Temporary views of a test are listed with the tables of every database, so later tests would see them."""
    yield
    if "spark" in request.fixturenames:
        catalog = request.getfixturevalue("spark").catalog
        for table in catalog.listTables():
            if table.isTemporary:
                catalog.dropTempView(table.name)
