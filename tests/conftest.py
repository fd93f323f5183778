import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

TOP = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(TOP))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallgrass.plans.workers import share_code

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "3g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    share_code(session)
    yield session
    session.stop()
