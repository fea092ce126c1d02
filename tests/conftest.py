import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ratemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
            # Plans show whole paths, however long the folder of the tests is.
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": tmp_path_factory.mktemp("events").as_uri(),
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def executed_plans(spark):
    """A function: the plans of all executions since the test began, first and adapted ones."""
    folder = Path(spark.conf.get("spark.eventLog.dir").removeprefix("file://"))
    (log,) = folder.iterdir()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    start = log.stat().st_size

    def plans() -> list[str]:
        bus.waitUntilEmpty()
        with log.open("rb") as events:
            events.seek(start)
            lines = [line for line in events if b'"physicalPlanDescription"' in line]
        return [json.loads(line)["physicalPlanDescription"] for line in lines]

    return plans
