import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """column(expression, values...) -> the values of a one-argument expression."""
    from pyspark.sql import functions as F

    def run(expression, values, type_="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}").select("i", expression(F.col("v")).alias("out"))
        return [r.out for r in sorted(df.collect(), key=lambda r: r.i)]

    return run
