import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fieldsync.schemas import schema  # noqa: E402
from fieldsync.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=2, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows of a declared table from dicts; columns left out are NULL."""

    def build(table, *rows):
        declared = schema(table)
        names = declared.fieldNames()
        for row in rows:
            unknown = set(row) - set(names)
            assert not unknown, unknown
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], declared)

    return build
