import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.local.dir", f"{folder}/local").config("spark.checkpoint.dir", f"{folder}/shared").config("spark.sql.warehouse.dir", f"{folder}/warehouse").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def one(spark):
    """The value of a column expression over literals."""
    return lambda *columns: tuple(spark.range(1).select(*columns).first()) if len(columns) > 1 else spark.range(1).select(*columns).first()[0]
