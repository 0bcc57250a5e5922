import pytest

from tidewell.session import build


@pytest.fixture(scope="session")
def spark():
    session = build("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
