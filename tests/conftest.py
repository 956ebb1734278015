import pytest

from kindred.session import build_session
from kindred.shared import ship_package


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one expression over one string."""
    from pyspark.sql import functions as F

    def run(function, text):
        frame = spark.createDataFrame([(text,)], "text string")
        return frame.select(function(F.col("text")).alias("out")).first()["out"]

    return run
