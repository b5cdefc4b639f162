"""The package on the workers, wherever the driver was started."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Give the session's Python workers this package (and the pipeline beside it) as a zip; once a context."""
    sc = spark.sparkContext
    if getattr(sc, "_corpusloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    sources = [p for p in (*sorted(root.rglob("*.py")), root.parent / "corpus_pipeline.py") if p.is_file()]
    digest = hashlib.sha256(b"\0".join(p.read_bytes() for p in sources)).hexdigest()[:12]
    at = Path(tempfile.mkdtemp(prefix="corpusloom-")) / f"corpusloom_{digest}.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sources:
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(str(at))
    sc._corpusloom_shipped = True
