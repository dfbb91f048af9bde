import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabflow.session import build_session

    scratch = tempfile.mkdtemp(prefix="tabflow-tests-")
    s = build_session(
        "local[4]", app_name="tabflow-tests", shuffle_partitions=4,
        **{"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
           "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()),
                  key=lambda t: tuple((v is None, 0 if v is None else v) for v in t))
