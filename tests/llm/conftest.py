import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    import edge
    import pages_edge

    return edge.write(spark, str(tmp_path_factory.mktemp("edge")), pages=pages_edge.rows())


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    import edge

    return edge.write(spark, str(tmp_path_factory.mktemp("empty")), rows=[], labels=[])


@pytest.fixture(scope="session")
def docs(spark, edge_dir):
    return spark.read.parquet(f"{edge_dir}/documents.parquet").cache()
