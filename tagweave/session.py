"""Sessions, and shipping this package to executors that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package's sources (some 100 KB), once an application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="tagweave-")) / "tagweave.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(path))
        _shipped.add(app)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    return ship(
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
