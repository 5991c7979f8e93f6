"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED = {
    # timestamps are UTC wall-clock everywhere
    "spark.sql.session.timeZone": "UTC",
    # a repeated attribute key keeps its last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # a repeated key inside a JSON object keeps its last value instead of failing the payload
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings above; performance settings stay with the cluster."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A local session that names none (tests) gets a local folder, which is remembered.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="spanlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
