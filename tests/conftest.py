import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_GATE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from itemwise.session import local_session
    session = local_session("*", 8, app="itemwise-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """The golden micro case of FIXTURES.md section 3."""
    from itemwise.operators import explode_history, last_preference
    feats = spark.createDataFrame(
        [("u1", "1:5 2:3 3:1"), ("u2", "1:2 2:4"), ("u3", "2:1 3:5"), ("u4", "4:1"),
         ("u5", "3:7")], "user_id string, feature string")
    hist = last_preference(explode_history(feats))
    labels = spark.createDataFrame([(i, f"L{i}") for i in range(1, 5)],
                                   "column_index bigint, label string")
    return feats, hist, labels
