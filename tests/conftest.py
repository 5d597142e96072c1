import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tarn.session import use_utc  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tarn-tests").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield use_utc(session)
    session.stop()
