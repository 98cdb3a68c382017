import logging
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    for name in ("SQLQueryContextLogger", "DataFrameQueryContextLogger"):
        logging.getLogger(name).setLevel(logging.CRITICAL)
    session = (
        SparkSession.builder.master("local[8]").appName("tallyframe-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
