import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
    session = builder.config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-")).config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoint-")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
