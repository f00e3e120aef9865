import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def make_points(spark):
    """A frame ``(row_id, x, ...)`` from a matrix and extra columns."""
    def make(x, **extra):
        names = ["row_id", "x", *extra]
        rows = [(i, [float(v) for v in r], *(c[i] for c in extra.values())) for i, r in enumerate(np.asarray(x))]
        types = {"fold": "int", "target": "double", "label": "double"}
        schema = "row_id bigint, x array<double>" + "".join(f", {n} {types.get(n, 'int')}" for n in extra)
        assert len(names) == len(rows[0])
        return spark.createDataFrame(rows, schema)
    return make
