import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sqlloom.session import local_session

    session = local_session(
        4, partitions=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ev(spark):
    """Evaluate a Column -> Column function on literal texts."""
    from pyspark.sql import functions as F

    def run(fn, *texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, x string").select("i", fn(F.col("x")).alias("y"))
        return [r["y"] for r in df.orderBy("i").collect()]

    return run
