import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from shared import NOW, SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from gatelog import configure

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def feeds(spark):
    from gatelog.catalog.feeds import Feeds

    return Feeds(spark, SF_DIR)


@pytest.fixture
def warehouse(spark, tmp_path):
    from gatelog.sources.tables import Warehouse

    return Warehouse(spark, str(tmp_path / "warehouse")).create(NOW)


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Build raw rows from (badge, user, zone, event time, ingestion time, **overrides)."""
    from gatelog import schemas

    def build(*rows):
        defaults = {
            "badge_id": "B1", "user_id": "USR-001", "zone_id": "ZONE-LOBBY-1",
            "reader_id": "RDR-101", "event_timestamp": NOW, "signal_strength": None,
            "signal_quality": "STRONG", "direction": "ENTRY", "ingestion_time": NOW,
            "raw_json": "{}",
        }
        return spark.createDataFrame(
            [tuple({**defaults, **row}[n] for n in schemas.RAW.names) for row in rows],
            schemas.RAW,
        )

    return build
