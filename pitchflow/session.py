"""Session settings used by the tests and the bench, and the folder that a session shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitchflow") -> SparkSession:
    """A local session. On a cluster use the session the cluster provides:
    nothing in this package depends on a setting made here."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """A new name for a folder below ``spark.checkpoint.dir``, which driver and executors share.

    A session in one process that names none gets a temporary folder; any other is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pitchflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
