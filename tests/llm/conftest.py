import pytest

from wattloom.llm.common import prepare


@pytest.fixture(autouse=True)
def shipped(spark):
    prepare(spark)
