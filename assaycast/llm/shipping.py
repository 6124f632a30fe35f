"""Makes the package importable in Python workers, and bounds the batches that they are sent."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent: set[str] = set()
#: Bytes of an Arrow batch; Spark bounds rows first, so long texts alone would make batches of any size.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once per application, unless their path has it (PYTHONPATH or ``--py-files``).

    The session's Arrow batches hold at most ``BATCH_BYTES`` from then on, or one longer row.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if sc.applicationId in _sent or _ROOT in known or ".zip" in _ROOT:
        return
    _sent.add(sc.applicationId)
    base = os.path.join(tempfile.mkdtemp(prefix="run-"), "assaycast")
    sc.addPyFile(shutil.make_archive(base, "zip", _ROOT, "assaycast"))
