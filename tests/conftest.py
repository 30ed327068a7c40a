import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cores=4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
