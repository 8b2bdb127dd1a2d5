"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # exact quantiles keep one small map per group; a month has 168 hourly groups and
    # about 1,700 tip groups, and the default of 128 would sort every task's rows
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # recording the Python call site of every column costs more than planning
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "curbline", master: str | None = None, **settings) -> SparkSession:
    """Session with UTC calendar fields and adaptive execution.

    Memory, cores and shuffle parallelism belong to the deployment; pass them in
    ``settings`` (dots written as ``__``) or through spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin calendar arithmetic of an existing session to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse a session whose calendar fields would not be those of UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"calendar fields are UTC here, but spark.sql.session.timeZone is {zone}; call session.use_utc")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path all executors can reach.

    It lies under the cluster's ``spark.checkpoint.dir``. Where that is unset, a
    local session gets a temporary directory (driver and tasks are one machine);
    any other master is refused, because each executor would write to its own disk
    and later reads would miss rows.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
        base = tempfile.mkdtemp(prefix="curbline-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(*sessions: SparkSession):
    """Shuffle files go when their query ends, not when the driver next collects its garbage.

    A load makes some thirty shuffles one after the other; kept to its end they take more
    room than the trips.
    """
    before = [(s, s.conf.get(SHUFFLE_CLEANUP, "false")) for s in sessions]
    for s in sessions:
        s.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        for s, value in reversed(before):
            s.conf.set(SHUFFLE_CLEANUP, value)


def settled(df: DataFrame, purpose: str = "settled") -> DataFrame:
    """The same rows, written once to shared storage and read back.

    For an aggregate that several steps read: it is computed once, its lineage
    ends here, and losing an executor costs nothing.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
