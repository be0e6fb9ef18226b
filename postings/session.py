"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime SQL settings: safe to set on a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value, as a dict would.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A batch of many small files is listed by so many tasks, not by one for each file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    # Plans name the filters of a scan in full, however long the numbers of their columns have become.
    "spark.sql.maxMetadataStringLength": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "postings", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a configured session; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    # Recording the Python line of every column expression makes long plans slow to build.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


@contextlib.contextmanager
def exchanges_leave(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no exchanges on disk: they go with their query, not when the driver's memory is swept."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Executors on other hosts must be able to read what is written here, so a temporary folder of
    this machine is only used when the session itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="postings-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

