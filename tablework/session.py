"""Session construction and shared-storage helpers.

Library code never creates its own session: every operator receives a
DataFrame (or a session) from the caller.  ``get_session`` exists for tests,
``bench.py`` and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths handed out by ``scratch_path`` and not yet cleared.
_SCRATCH: list[str] = []

#: The folder of each local application that has no ``spark.checkpoint.dir``.
_LOCAL_DIRS: dict[str, str] = {}

# Settings applied by ``get_session``.  On a cluster these come from the
# cluster's spark-defaults; the values here suit local[N] runs.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tablework", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage (HDFS/S3/...) and is read
    as it is; without it a cluster session raises, since a folder on the
    driver's disk is invisible to executors.  Only a local session gets a
    temporary folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tablework-ckpt-")
        d = _LOCAL_DIRS[app]
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


def is_local(master: str) -> bool:
    """Whether a master URL runs everything in the driver's process."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for written intermediate tables, stream checkpoints and round-trip
    outputs so that every task on every executor sees the same data.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/{label}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def is_scratch(folder: str) -> bool:
    """Whether ``scratch_path`` has handed out ``folder``, which may be written with or without its scheme."""
    return os.path.basename(folder) in {os.path.basename(p) for p in _SCRATCH}


def stage(df: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back,
    so that several uses do not derive it again and see the same rows.

    With ``most`` a file holds at most so many rows, and a task reads files of
    16 MB together (or one larger file): for uses that hold a task's rows as
    objects, many times as large as their columns in the file.
    """
    spark = df.sparkSession
    p = scratch_path(spark, label)
    if most is None:
        df.write.parquet(p)
    else:
        df.write.option("maxRecordsPerFile", most).parquet(p)
        spark = side_session(spark, {"spark.sql.files.maxPartitionBytes": str(16 << 20)})
    return spark.read.schema(df.schema).parquet(p)


def side_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Another session of the same application with the SQL settings of ``spark`` and some of its own.

    ``spark`` itself and what runs in it are not touched.
    """
    side = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            side.conf.set(name, value)
    for name, value in settings.items():
        side.conf.set(name, value)
    return side


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, on whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def clear_scratch(spark: SparkSession) -> int:
    """Delete what ``scratch_path`` handed out in this application; returns the number of paths.

    Call it when no DataFrame that reads them is used any more.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n
