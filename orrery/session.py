"""Session settings the library is designed around.

The library works in any Spark session; nothing here is required.  AQE matters
most: it turns a shuffle join into a broadcast join only after it has *measured*
the small side, and it splits the partitions of hot keys in the fact joins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8000 bytes.  Without this limit a stage
    # with many rules runs as one interpreted method, several times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(
    app: str = "orrery",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings above; `master` is for local work and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The scratch folder that driver and executors share: `spark.checkpoint.dir`.

    Where it is unset, a folder of the application below `java.io.tmpdir` serves, but
    only if driver and executors are one process; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = context._jvm.java.lang.System.getProperty("java.io.tmpdir")
    folder = f"file:{local}/orrery-{context.applicationId}"
    _gone_at_exit(spark, folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _gone_at_exit(spark, path)
    return path


def _gone_at_exit(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    # Deletion at exit is only noted for paths that exist.
    system.mkdirs(place.getParent())
    if not system.deleteOnExit(place):
        system.mkdirs(place)
        system.deleteOnExit(place)
        system.delete(place, True)
