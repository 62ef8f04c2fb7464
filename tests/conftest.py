from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from seriesrel.session import build_session
    s = build_session("local[4]", app_name="seriesrel-tests", shuffle_partitions=8)
    yield s
    s.stop()
