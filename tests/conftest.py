from __future__ import annotations

import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))

from ledgerstar.session import CHECKPOINT_DIR, build_session  # noqa: E402

F1 = Path(__file__).with_name("data") / "admissions_f1.csv"
SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgerstar-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get(CHECKPOINT_DIR, None) is None:
        session.conf.set(CHECKPOINT_DIR, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def f1_lines():
    return F1.read_text(encoding="utf-8").splitlines()


@pytest.fixture
def csv_file(tmp_path):
    """Write lines to a fresh CSV and return its path."""

    def write(lines, name="input.csv"):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write
