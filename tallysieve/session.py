"""What a session needs: the settings the plans are written for, and this package on the workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JIT compiler skips methods beyond 8000 bytes of bytecode; past that, split functions run faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application: tasks import it, wherever the driver was started."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tallysieve-")) / f"{package.name}.zip"  # on the driver, which hands it out
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)
