from __future__ import annotations

import pytest

from tillgrid.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tillgrid-tests", "8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
