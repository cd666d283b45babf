import os
import sys
from contextlib import contextmanager

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from almanack.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for the length of a block."""

    @contextmanager
    def change(**values):
        names = {k.replace("__", "."): str(v) for k, v in values.items()}
        before = {k: spark.conf.get(k, None) for k in names}
        for k, v in names.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return change


@pytest.fixture
def lines(spark, tmp_path):
    """Write lines to a file and read them as Spark reads text."""

    def write(*rows: str):
        path = tmp_path / "lines.txt"
        path.write_text("\n".join(rows) + "\n")
        return spark.read.text(str(path))

    return write
