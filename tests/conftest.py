from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from replygauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "tests", {"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of a column expression over a list of texts."""

    def values(texts, expression, name="t"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {name} string")
        return [row.x for row in df.select("i", expression.alias("x")).orderBy("i").collect()]

    return values
