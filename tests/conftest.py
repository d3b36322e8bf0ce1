import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    from loquent.sources.warehouse import Warehouse

    made = Warehouse(spark, str(tmp_path / "warehouse"))
    made.create_tables()
    return made


@pytest.fixture
def one(spark):
    """Value of an expression over one row of named values."""

    def evaluate(expression, schema="", *values):
        row = spark.createDataFrame([values or (0,)], schema or "unused INT")
        return row.select(expression.alias("value")).first()["value"]

    return evaluate


# A short talk: an empty text, texts of one and of several sentences, a name that
# occurs twice, and a change of subject.
TALK = [
    (1, "Boats leave the harbour before dawn. Cold fog sits on the water until eight."),
    (2, ""),
    (3, "Mira Holt keeps the ledger of every catch."),
    (4, "Prices are written on slate. A crate of herring sells first, and Otto Lind buys it before Mira Holt has closed her book. Mira Holt does not mind."),
    (5, "Tax forms for islands are another matter."),
    (6, "A clerk reads each form in winter, stamps it and files it under salt."),
]


@pytest.fixture
def talk(spark):
    return spark.createDataFrame(
        [("v1", i, t) for i, t in TALK], "video_id STRING, segment_id BIGINT, text STRING"
    )
