"""Session settings the warehouse relies on, and where its scratch files go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Staging text and DATE boundaries are read in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # A bad price, date or timestamp must fail the load rather than turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Key checks of small batches name their keys, which row groups are skipped by.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Two joins in a row on the same key share one stage, and Spark then leaves a
    # hot key alone because splitting it costs the second join a shuffle. For one
    # customer owning a large part of all vehicles that shuffle is the cheaper side.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder:
    on a cluster such a folder would exist on one machine only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="dealerlake-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
