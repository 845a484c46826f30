from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

from orrery.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    session = get_session(
        "orrery-tests",
        master="local[4]",
        shuffle_partitions=4,
        **{
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def table(spark):
    """table("a string, b int", rows...) -> DataFrame"""

    def make(schema: str, *rows) -> DataFrame:
        return spark.createDataFrame(list(rows), schema)

    return make


def strings(columns) -> str:
    return ", ".join(f"{c} string" for c in columns)


def values(df: DataFrame, column: str) -> list:
    return [row[0] for row in df.select(column).collect()]
