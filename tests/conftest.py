import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quadrille.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests", "local[8]", spark__sql__shuffle__partitions="3", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__sql__autoBroadcastJoinThreshold="1m",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _floats(row, coords):
    return tuple(row[: len(row) - coords]) + tuple(float(v) for v in row[-coords:])


@pytest.fixture
def points(spark):
    def make(rows, parts=1):
        schema = "x double, y double" if not rows or len(rows[0]) == 2 else "id long, x double, y double"
        return spark.createDataFrame([_floats(r, 2) for r in rows], schema).repartition(parts)

    return make


@pytest.fixture
def rects(spark):
    def make(rows):
        corners = "x1 double, y1 double, x2 double, y2 double"
        schema = corners if not rows or len(rows[0]) == 4 else "id long, " + corners
        return spark.createDataFrame([_floats(r, 4) for r in rows], schema)

    return make
