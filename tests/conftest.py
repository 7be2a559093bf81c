import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rosterweave.config import Settings  # noqa: E402
from rosterweave.plans.staging import Stage  # noqa: E402
from rosterweave.session import spark_session  # noqa: E402

REPORT_DATE = dt.date(2002, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings():
    return Settings(report_date=REPORT_DATE)


@pytest.fixture
def stage(spark, tmp_path):
    return Stage(spark, str(tmp_path))
