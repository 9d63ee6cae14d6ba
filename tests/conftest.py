"""A shared local session and small helpers."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from podwatch.session import build_session  # noqa: E402
from podwatch.streaming.cooldown import ROCKSDB_PROVIDER  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "podwatch-tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength=2000,
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def database(spark, request):
    """A fresh database of its own for a test."""
    name = "db_" + re.sub(r"\W", "_", request.node.name.lower())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name
