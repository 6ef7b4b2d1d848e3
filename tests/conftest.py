import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from rillmark.session import configure

    return configure(session)


@pytest.fixture
def frame(spark):
    """Rows of text columns: frame("a b", ("1", None), ...)."""

    def make(names, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ", ".join(f"`{n}` string" for n in names.split()))

    return make
