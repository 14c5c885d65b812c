import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from cohortlake.operators.staging import stage_all
from cohortlake.session import configure
from cohortlake.sources.csvfiles import read_csv_layer
from tests.fixture import AS_OF, CSV

_FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SOURCE = _FOLDER if os.path.isdir(_FOLDER) else None


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cohortlake-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config(
            "spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch} -XX:+UseParallelGC"
        )
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def csv_folder():
    folder = tempfile.mkdtemp(prefix="cohortlake-csv-")
    for table, text in CSV.items():
        with open(os.path.join(folder, f"{table}.csv"), "w", encoding="utf-8") as f:
            f.write(text.strip() + "\n")
    return folder


@pytest.fixture(scope="session")
def raw(spark, csv_folder):
    return {t: df.cache() for t, df in read_csv_layer(spark, csv_folder).items()}


@pytest.fixture(scope="session")
def staged(raw):
    return {t: df.cache() for t, df in stage_all(raw, AS_OF).items()}
