import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from berthline.session import apply_recommended  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("berthline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = apply_recommended(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def recs(spark):
    """JSON texts to a DataFrame with the variant column rec and the text's number."""

    def make(*texts):
        df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
        return df.select("n", F.parse_json("value").alias("rec"))

    return make


@pytest.fixture
def one(spark):
    """Values of column expressions over a one-row frame of texts."""

    def make(*columns, **values):
        names = list(values) or ["x"]
        row = [tuple(values.values()) or (None,)]
        df = spark.createDataFrame(row, ", ".join(f"{n} string" for n in names))
        return tuple(df.select(*columns).first())

    return make


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
