"""Making the package importable in Python workers, wherever the driver was started."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from stratalog.plans.lineage import fresh_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's source, written to the shared folder, to the application's Python files, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh_path(spark, 'source')}/stratalog_src.zip")
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(str(at))
    _shipped.add(sc.applicationId)
