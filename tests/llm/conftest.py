import pytest

from orderloom.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
