import pytest

from rainledger.llm.common import ship
from tests.llm.data import write_tables


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """(folder, documents) with the awkward cases."""
    ship(spark)
    return write_tables(spark, tmp_path_factory.mktemp("tables"))


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    ship(spark)
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [], [])[0]
