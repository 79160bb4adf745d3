import os
import sys
import tempfile

import pytest
from hypothesis import settings
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Property tests are reproducible by default; HYPOTHESIS_PROFILE=explore draws fresh inputs.
settings.register_profile("repeatable", derandomize=True)
settings.register_profile("explore", derandomize=False)
settings.load_profile(os.environ.get("HYPOTHESIS_PROFILE", "repeatable"))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("tablewright-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # shared folder: the session's own setting, or one of our own (tests only)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tw-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from tablewright.session import new_work_dir
    return new_work_dir(spark, "test")


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


def write_text(path: str, text: str, encoding: str = "utf-8") -> str:
    os.makedirs(os.path.dirname(local_path(path)), exist_ok=True)
    with open(local_path(path), "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path
