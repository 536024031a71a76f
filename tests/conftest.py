from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from salesmart.functions import calendar  # noqa: E402
from salesmart.operators.dims import Dims  # noqa: E402
from salesmart.session import local_session  # noqa: E402
from salesmart.sources import seeds  # noqa: E402
from salesmart.sources.warehouse import Warehouse  # noqa: E402
from salesmart.storage import Scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    extra = {"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2", "spark.driver.memory": "6g", "spark.checkpoint.dir": shared}
    session = local_session(4, "tests", **extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture(scope="session")
def dims(spark, tmp_path_factory):
    """The seed dimensions, as written tables."""
    built = Dims(
        store=seeds.stores(spark, "Cafe"),
        product=seeds.products(spark),
        payment=seeds.payments(spark),
        date=calendar.build(spark),
    )
    return Warehouse(spark, str(tmp_path_factory.mktemp("dims"))).write_dims(built)


@pytest.fixture
def warehouse(spark, dims, tmp_path):
    house = Warehouse(spark, str(tmp_path / "warehouse")).create()
    house.write_dims(dims)
    return house
