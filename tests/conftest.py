from __future__ import annotations

import pytest

from lodestar.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    def collected(df, *cols):
        """Rows as a sorted list of tuples, NULL first."""
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))

    return collected
