from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("SPARK_DRIVER_MEMORY", "8g")

from pricestrata.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build("local[8]", "tests", 8, {"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    return session
