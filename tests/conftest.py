import pytest

from flowkit.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make


def rows(df):
    """Rows as plain tuples, sorted by their text."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
