import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from curate.fixed_values import ATTENDANCE_HEADERS  # noqa: E402
from curate.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": os.environ.get("TEST_WAREHOUSE", "/tmp/curate-warehouse"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


# Ten records with one of each defect: an exact repeat, every date format, an
# impossible date, bad ages, counts that do not add up.
SAMPLE = [
    ("R-0007", "Ada", "46", "West", "Export", "2024-05-20", "9", "8", "1"),
    ("R-0012", "Ben", "25", "North", "Growth", "14/05/2024", "10", "6", "4"),
    ("R-0033", "Cem", "18", "North", "Growth", "45230", "9", "1", "8"),
    ("R-0041", "Dov", "150", "East", "Marketing", "2024-08-24", "6", "2", "4"),
    ("R-0055", "Eva", "thirty", "West", "Export", "2024-13-45", "10", "10", "0"),
    ("R-0068", "Fay", "62", "East", "Growth", "2024-01-04", "2", "0", "2"),
    ("R-0072", "Gus", "-5", "North", "Marketing", "2024-03-11", "5", "3", "3"),
    ("R-0088", "Hal", "34", "West", "Export", "2024/06/30", "8", "8", "0"),
    ("R-0090", "Ida", "29", "East", "Growth", "2024-07-15", "7", "5", "2"),
    ("R-0007", "Ada", "46", "West", "Export", "2024-05-20", "9", "8", "1"),
]


def raw_frame(spark, rows):
    columns = ", ".join(f"`{h}` string" for h in ATTENDANCE_HEADERS)
    return spark.createDataFrame(rows, columns)


@pytest.fixture
def sample(spark):
    return raw_frame(spark, SAMPLE)


@pytest.fixture
def records(spark):
    """Build a raw frame from rows."""
    return lambda rows: raw_frame(spark, rows)
