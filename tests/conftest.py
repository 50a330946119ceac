import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from airsift.session import local_session

    session = local_session("tests", cores="8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from catalog.inputs import Inputs

    return Inputs(spark, SMALL)
