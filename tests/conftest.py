import pathlib
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("millrace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return pathlib.Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


@pytest.fixture
def text_of():
    def read(path):
        return {
            str(p.relative_to(path)): p.read_bytes().decode("utf-8", "surrogateescape")
            for p in sorted(pathlib.Path(path).rglob("*"))
            # folders with a dot in front are not data
            if p.is_file() and not p.name.endswith(".crc") and not any(x.startswith(".") for x in p.relative_to(path).parts[:-1])
        }

    return read
