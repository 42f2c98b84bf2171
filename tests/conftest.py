import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tools")):
    sys.path.insert(0, path)

RATINGS_SCHEMA = "user_id BIGINT, item_id BIGINT, pref FLOAT"

# Fixture: 5 users, 7 items.
SMALL_RATINGS = [
    (1, 101, 5.0), (1, 102, 3.0), (1, 103, 2.5), (2, 101, 2.0), (2, 102, 2.5), (2, 103, 5.0),
    (2, 104, 2.0), (3, 101, 2.5), (3, 104, 4.0), (3, 105, 4.5), (3, 107, 5.0), (4, 101, 5.0),
    (4, 103, 3.0), (4, 104, 4.5), (4, 106, 4.0), (5, 101, 4.0), (5, 102, 3.0), (5, 103, 2.0),
    (5, 104, 4.0), (5, 105, 3.5), (5, 106, 4.0),
]

# Fixture: 4 users, 9 items.
PEARSON_RATINGS = [
    (1, 10, 1.0), (1, 11, 2.0), (1, 12, 5.0), (1, 13, 5.0), (1, 14, 5.0), (1, 15, 4.0), (1, 16, 5.0),
    (1, 17, 1.0), (1, 18, 5.0), (2, 10, 1.0), (2, 11, 2.0), (2, 15, 5.0), (2, 16, 4.5), (2, 17, 1.0),
    (2, 18, 5.0), (3, 11, 2.5), (3, 12, 4.5), (3, 13, 4.0), (3, 14, 3.0), (3, 15, 3.5), (3, 16, 4.5),
    (3, 17, 4.0), (3, 18, 5.0), (4, 10, 5.0), (4, 11, 5.0), (4, 12, 5.0), (4, 13, 0.0), (4, 14, 2.0),
    (4, 15, 3.0), (4, 16, 1.0), (4, 17, 4.0), (4, 18, 1.0),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tideline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_ratings(spark):
    return spark.createDataFrame(SMALL_RATINGS, RATINGS_SCHEMA)


@pytest.fixture
def pearson_ratings(spark):
    return spark.createDataFrame(PEARSON_RATINGS, RATINGS_SCHEMA)


@pytest.fixture
def lines(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "value STRING")
    return make
