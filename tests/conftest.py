from __future__ import annotations

import pytest

from caseworks.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A session in a zone with daylight saving, to show that nothing depends on the zone."""
    session = local_session(
        "4",
        "tests",
        **{
            "spark.sql.session.timeZone": "Europe/Paris",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    yield session
    session.stop()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
