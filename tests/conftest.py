import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattloom.session import local_session, shared_folder  # noqa: E402
from wattloom.sources.tables import Tables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, request, tmp_path):
    """Empty tables in a folder of their own."""
    return Tables(spark, f"{shared_folder(spark)}/tests/{os.getpid()}-{tmp_path.name}")


@pytest.fixture
def ts():
    def make(text: str) -> datetime:
        return datetime.fromisoformat(text)

    return make


def rows(df, *columns):
    """Rows as sorted tuples, for comparing without an order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")
    return df._jdf.queryExecution().explainString(mode).split("== Physical Plan ==")[1]
