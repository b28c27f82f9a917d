import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacancylake.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("vacancylake-tests", cores="4", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column rule over one text column, in row order."""

    def evaluate(values, rule, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r.out for r in rows.select("i", rule("v").alias("out")).orderBy("i").collect()]

    return evaluate
