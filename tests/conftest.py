import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from leafwright.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """``values(texts, fn)``: ``fn`` of each text, in order."""

    def run(texts, fn):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
        rows = df.select("i", fn(df["c"]).alias("v")).collect()
        return [r.v for r in sorted(rows, key=lambda r: r.i)]

    return run
