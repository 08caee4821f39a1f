import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as sorted tuples."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def grid_frame(spark, array, value="value", kind="DOUBLE"):
    """Cells of a nested list; None is masked."""
    data = [(y, x, v) for y, line in enumerate(array) for x, v in enumerate(line)]
    return spark.createDataFrame(data, f"y INT, x INT, {value} {kind}")


def as_grid(df, value="value"):
    got = {(r["y"], r["x"]): r[value] for r in df.collect()}
    ny, nx = max(y for y, _ in got) + 1, max(x for _, x in got) + 1
    return [[got.get((y, x)) for x in range(nx)] for y in range(ny)]
