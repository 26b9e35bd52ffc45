import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import local_session, with_folder

    session = local_session(os.environ.get("TEST_CPUS", "8"), "panelkit-tests")
    session.sparkContext.setLogLevel("ERROR")
    return with_folder(session)


@pytest.fixture()
def frame(spark):
    """Rows as a DataFrame: ``frame("region string, value double", rows)``."""

    def make(schema, rows):
        return spark.createDataFrame(rows, schema)

    return make


def cells(df, *keys, value="value"):
    """``{key: value}`` of a small DataFrame."""
    out = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]
        assert key not in out, f"key {key} twice"
        out[key] = row[value]
    return out
