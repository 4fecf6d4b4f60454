import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(__file__)), os.path.dirname(__file__)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fleetday-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def _compile_only_the_registered_queries(request, spark):
    """Compiling a plan costs more than running it on a handful of literal rows."""
    whole = request.module.__name__ in ("test_oracle", "test_plans")
    spark.conf.set("spark.sql.codegen.wholeStage", str(whole).lower())
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK" if whole else "NO_CODEGEN")
