from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """Clicks with ties, a repeated (user, time), and a missing user."""
    rows = [
        (1, "u1", "a1", "2024-01-01 00:00:00", 0),
        (2, "u1", "a2", "2024-01-01 00:00:10", 1),
        (3, "u1", "a1", "2024-01-01 00:00:10", 1),
        (4, "u1", "a1", "2024-01-01 00:00:10", 0),
        (5, "u1", "a2", "2024-01-01 00:01:00.5", 1),
        (6, "u2", "a1", "2024-01-01 00:00:05", 1),
        (7, None, "a1", "2024-01-01 00:00:06", 1),
        (8, None, "a2", "2024-01-01 00:00:07", 0),
    ]
    df = spark.createDataFrame(rows, "impression_id bigint, user_id string, ad_id string, t string, clicked int")
    return df.selectExpr("impression_id", "user_id", "ad_id", "CAST(t AS TIMESTAMP_NTZ) AS timestamp", "clicked")


@pytest.fixture(scope="session")
def impressions(spark):
    import fixtures

    return fixtures.impressions(spark, SMALL).cache()


@pytest.fixture(scope="session")
def predictions(spark):
    import fixtures

    return fixtures.predictions(spark, SMALL).cache()
