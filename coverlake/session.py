"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A map task sorts the wide text rows of its split before it drops repeats. 16 MB of a packed table make up to a few
    # hundred MB of such rows, which a task holds without spilling; 128 MB do not.
    "spark.sql.files.maxPartitionBytes": "16m",
    # Shuffle files go when their job ends, not when the driver happens to collect garbage: a load of many tables holds
    # on disk what its running jobs shuffle, not what all have.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM does not compile methods over 8000 bytes. A projection over all columns of a feed exceeds that, and is
    # then faster as separately compiled expressions than as one fused loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app_name: str = "coverlake",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the engine relies on; `master` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under the folder the cluster names in `spark.checkpoint.dir`.

    The folder must be visible to every executor, so a machine-local temporary folder is used only where the
    setting is missing, as in local tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="coverlake-")
    return f"{shared.rstrip('/')}/coverlake/{label}-{uuid.uuid4().hex}"
