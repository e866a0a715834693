import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from annotask.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("checkpoints"))
    session = build_session("local[4]", 8, app_name="annotask-tests", extra={"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def write_text():
    """Write files: {relative path: text} under a folder; returns the folder."""

    def _write(root, files):
        for rel, text in files.items():
            path = os.path.join(str(root), rel)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8") as fh:
                fh.write(text)
        return str(root)

    return _write
