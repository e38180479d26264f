import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gleaner-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def own_methods():
    """A class that is pickled by value and loaded in the same process takes the loaded methods; it gets its own back."""
    packing = sys.modules.get("gleaner.llm.packing")
    before = dict(vars(packing.WordTokenizer)) if packing else {}
    yield
    for name, value in before.items():
        if vars(packing.WordTokenizer).get(name) is not value:
            setattr(packing.WordTokenizer, name, value)
