from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from doselake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        "4",
        "doselake-tests",
        **{
            "spark.checkpoint.dir": f"file://{folder}",
            "spark.sql.shuffle.partitions": "2",
            "spark.sql.warehouse.dir": f"file://{folder}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from doselake.registry import lake_of

    return lake_of(spark, SF_DIR)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
