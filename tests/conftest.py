from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmill.session import pin_utc  # noqa: E402
from tripmill.sources.workdir import delete_workdirs  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin_utc(session)
    delete_workdirs(session)
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
