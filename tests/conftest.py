import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
