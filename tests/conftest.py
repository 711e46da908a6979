import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.config import Lake  # noqa: E402
from stratalake.sinks.tables import create_lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stratalake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    """An empty lake with its tables."""
    made = Lake(
        root=str(tmp_path / "tables"),
        stage_root=str(tmp_path / "stage"),
        database_prefix=f"t{uuid.uuid4().hex[:12]}_",
    )
    create_lake(spark, made)
    return made


@pytest.fixture
def stage(lake):
    """Writes text as a file of a stage folder."""

    def write(table: str, load_date: str, text: str, name: str = "part.csv") -> str:
        folder = Path(lake.stage_root) / "table_ingestion_files" / table / load_date
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")
        return str(folder)

    return write
