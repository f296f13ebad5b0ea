import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    return get_session(master="local[*]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, sf001):
    """doc_id -> text of the smallest documents table."""
    return dict(spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text").collect())
