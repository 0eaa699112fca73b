import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="keelson-test-")
    s = build_session(
        master="local[4]",
        app_name="keelson-tests",
        shuffle_partitions=4,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def files(folder):
    """Name -> size of every data file below a folder."""
    return {os.path.join(d, n): os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def damage(folder):
    """Cut every data file below a folder off in the middle of its footer."""
    for path, size in files(folder).items():
        with open(path, "r+b") as f:
            f.truncate(size - 6)
        crc = os.path.join(os.path.dirname(path), "." + os.path.basename(path) + ".crc")
        if os.path.exists(crc):
            os.remove(crc)
