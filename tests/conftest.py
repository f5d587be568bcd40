import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfline.session import local_session

    home = tmp_path_factory.mktemp("spark")
    session = local_session("4", shuffle_partitions=4, **{"spark.sql.warehouse.dir": str(home / "warehouse")})
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
