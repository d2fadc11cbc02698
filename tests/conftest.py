import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clearledger import session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "clearledger-tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def column_of(spark):
    """Apply a column function to literal texts, in order."""
    from pyspark.sql import functions as F

    def run(make, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
        out = rows.select("i", make(F.col("c")).alias("v")).collect()
        return [row.v for row in sorted(out)]

    return run
