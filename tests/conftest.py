import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from casemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "casemill-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_cases(spark):
    def make(*rows):
        """Rows of (case_id, subject, entry_date, register_date); missing tail is NULL."""
        padded = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame(
            padded, "case_id string, subject string, entry_date string, register_date string"
        )

    return make


@pytest.fixture
def make_status(spark):
    from casemill.schema import STATUS

    def make(*rows):
        """Rows of (domain, case_id, category, processed, method)."""
        return spark.createDataFrame(list(rows), STATUS)

    return make


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
