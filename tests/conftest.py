import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from meshfold.session import local_session, prepare

    return prepare(local_session(4, "4g", "tests"))


@pytest.fixture(scope="session")
def make(spark):
    """Rows and a DDL schema to a DataFrame."""
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build
