from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue import CATALOGUE_TYPES, catalogue_frame  # noqa: E402

from shelflight.roles import nan_to_null  # noqa: E402
from shelflight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def items_pd():
    return catalogue_frame()


@pytest.fixture(scope="session")
def items(spark, items_pd):
    return nan_to_null(spark.createDataFrame(items_pd, CATALOGUE_TYPES)).cache()
