import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def clicks_of(spark):
    """Clicks from text such as {1: "A A B"}: session to its items in order."""

    def build(sessions):
        rows = [
            (s, i, item, (ord(item[0]) - 65) if item else None)
            for s, items in sessions.items()
            for i, item in enumerate(items.split(), 1)
        ]
        return spark.createDataFrame(rows, "session_id long, click_order int, item_id string, item_no int")

    return build
