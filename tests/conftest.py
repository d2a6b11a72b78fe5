import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from siftline.session import build_session

    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of one expression over one row of named texts."""
    from pyspark.sql import functions as F

    def value(expression, **texts):
        names = list(texts) or ["x"]
        row = spark.createDataFrame([tuple(texts.get(n, "") for n in names)], ", ".join(f"{n} string" for n in names))
        return row.select(expression(*[F.col(n) for n in names]).alias("v")).first()[0]

    return value
