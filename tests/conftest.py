import pytest

from millrace.scratch import release
from millrace.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, "tests", partitions=4, **{"spark.checkpoint.dir": f"file://{shared}"})
    yield session
    release(session)
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame from rows and a DDL schema."""
    def make(schema, *rows):
        return spark.createDataFrame([tuple(r) if isinstance(r, (tuple, list)) else (r,) for r in rows], schema)
    return make


def rows_of(df, *columns):
    """Rows as sorted tuples; NULL sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
