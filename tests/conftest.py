import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYSPARK_PYTHON"] = sys.executable
os.environ["PYSPARK_DRIVER_PYTHON"] = sys.executable

from footfall.schemas import SENSOR_EVENT  # noqa: E402
from footfall.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="footfall-tests-")}
    s = build_session("local[4]", app_name="footfall-tests", shuffle_partitions=4, extra=shared)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


BASE = ("first", 61_000, "STORE_01", "ZONE_A", "SENSOR_9", "36-50", "female", 42.5)


def event(**changes):
    """A sensor-event row: the base row with fields replaced."""
    names = [f.name for f in SENSOR_EVENT.fields]
    row = dict(zip(names, BASE))
    row.update(changes)
    return tuple(row[n] for n in names)


@pytest.fixture
def events(spark):
    def make(rows):
        return spark.createDataFrame(rows, SENSOR_EVENT)

    return make
