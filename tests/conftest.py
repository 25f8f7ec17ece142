from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# The first transactions of the source data.
TX_ROWS = [
    (1, "PAYMENT", 9839.64, "C1231006815", 170136.0, 160296.36, "M1979787155", 0.0, 0.0, 0, 0),
    (1, "PAYMENT", 1864.28, "C1666544295", 21249.0, 19384.72, "M2044282225", 0.0, 0.0, 0, 0),
    (1, "TRANSFER", 181.0, "C1305486145", 181.0, 0.0, "C553264065", 0.0, 0.0, 1, 0),
    (1, "CASH_OUT", 181.0, "C840083671", 181.0, 0.0, "C38997010", 21182.0, 0.0, 1, 0),
    (1, "PAYMENT", 11668.14, "C2048537720", 41554.0, 29885.86, "M1230701703", 0.0, 0.0, 0, 0),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """With a shared folder set, as on a cluster."""
    from tillwatch.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    return local_session(8, **{"spark.checkpoint.dir": f"file://{shared}", "spark.ui.showConsoleProgress": "false"})


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def tx(spark):
    from tillwatch.schema import TX_SCHEMA

    return spark.createDataFrame(TX_ROWS, TX_SCHEMA)


def rows(df):
    """Rows as tuples, in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
