import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cardlake.session import get_spark  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "cardlake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cardlake-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cardlake-wh-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def path(tmp_path):
    return lambda name: str(tmp_path / name)


def rows(df, *cols):
    """Rows as sorted tuples, NULLs last."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda r: tuple((v is None, str(v)) for v in r))
