from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeplane.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = builder("tests").master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.showConsoleProgress", "false").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
