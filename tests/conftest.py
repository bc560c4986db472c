import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskengine.schema import KEYED_SCHEMA, PCA_FEATURES  # noqa: E402
from riskengine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def make_frame(n=200, seed=7, frauds=12):
    """Transactions with ties in Time and a few frauds all over the range."""
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"txn_id": np.arange(n), "Time": np.sort(rng.integers(0, 172800, n)) // 600 * 600.0})
    for c in PCA_FEATURES:
        frame[c] = rng.normal(size=n)
    frame["Amount"] = np.round(rng.exponential(88, n), 2)
    frame["Class"] = 0
    frame.loc[rng.choice(n, frauds, replace=False), "Class"] = 1
    return frame.astype({"Class": "int32"})


@pytest.fixture(scope="session")
def frame():
    return make_frame()


@pytest.fixture(scope="session")
def txn(spark, frame):
    return spark.createDataFrame(frame, KEYED_SCHEMA).cache()
