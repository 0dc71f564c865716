from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from parcelflow.session import build_session

    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
