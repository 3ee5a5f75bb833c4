from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for place in (ROOT, os.path.join(ROOT, "tests")):
    if place not in sys.path:
        sys.path.insert(0, place)


def session() -> SparkSession:
    return (SparkSession.builder.master("local[8]").appName("warcaudit tests")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
            .getOrCreate())


@pytest.fixture(scope="session")
def spark():
    live = session()
    live.sparkContext.setLogLevel("ERROR")
    yield live
    live.stop()
