from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from asfalto.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    opened = session(
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    opened.sparkContext.setLogLevel("ERROR")
    yield opened
    opened.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from asfalto.registry.lakes import gold_lake

    return gold_lake(spark, SMALL)
