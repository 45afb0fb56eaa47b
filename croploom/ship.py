"""Getting the package to executors that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_code(spark: SparkSession, *modules: str) -> None:
    """Send this package, and single modules beside it, to all executors; once per application.

    Spark copies the archive to every executor and puts it on the path of their Python workers, as
    ``--py-files`` would.  Where the package is installed everywhere this is not needed, and does no harm.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="croploom-code-")) / "croploom_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
        for m in modules:
            z.write(package.parent / m, m)
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
