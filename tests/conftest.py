from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("linktide-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from linktide.scratch import Scratch

    with Scratch(spark) as scratch:
        yield scratch


@pytest.fixture
def graph_of(spark, scratch):
    """Build a stored graph from Python lists of ids and pairs."""
    from linktide.operators.graph import clean_graph

    def build(nodes, links, **options):
        return clean_graph(
            spark.createDataFrame([(n,) for n in nodes], "id string"),
            spark.createDataFrame(list(links), "src string, dst string"),
            scratch,
            **options,
        )

    return build
