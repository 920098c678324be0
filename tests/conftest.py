from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tomeworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=8, memory="12g", name="tests")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
