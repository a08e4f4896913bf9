"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Settings the text formats rely on. The functions that need them also hold
# without them; a session made here simply skips the extra clean-up step.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Rows hold payloads of a megabyte: few of them at a time, in the reader and
    # on the way to Python.
    "spark.sql.parquet.columnarReaderBatchSize": "64",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


# Scratch folder of each local session that names no shared folder.
_LOCAL: dict[str, str] = {}

# Application and folder without a scheme that its executors were seen to share.
_SHARED: set[tuple[str, str]] = set()


def build_session(app: str = "frameweir", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is the one the cluster names in `spark.checkpoint.dir`. Where that is
    unset, a scratch folder is made, in local mode only: on a cluster the
    executors could not see it. A path without a scheme on a cluster whose
    default file system is local may be a folder of each machine's own, or one
    that all machines mount; tasks write there once, and it is refused unless all
    their rows are read back. A `file:` path is taken as named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and "://" not in folder and not folder.startswith("file:"):
        if not spark.sparkContext.master.startswith("local") and _is_local(spark, folder):
            _check_shared(spark, folder)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="frameweir-")
        folder = _LOCAL[context.applicationId]
    return folder.rstrip("/")


def _check_shared(spark: SparkSession, folder: str) -> None:
    """An error unless all executors and the driver see the same `folder`: two rows for
    each core, from as many tasks, are written there and read back."""
    asked = spark.sparkContext.applicationId, folder
    if asked in _SHARED:
        return
    try:
        tasks = 2 * spark.sparkContext.defaultParallelism
        path = f"{folder.rstrip('/')}/frameweir/seen-{uuid.uuid4().hex}"
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        seen = spark.read.schema("id long").parquet(path).distinct().count()
    except Exception as lost:  # files on other machines are missed in many ways
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, a folder of each machine's own") from lost
    if seen != tasks:
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, a folder of each machine's own: {seen} of {tasks} rows came back")
    _SHARED.add(asked)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _is_local(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path)[0].getUri().getScheme() == "file"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{work_dir(spark)}/frameweir/{name}-{uuid.uuid4().hex}"


# How Spark writes the files of a checkpoint by the file system itself.
_CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
_BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def checkpointed(writer: DataStreamWriter, checkpoint: str) -> DataStreamWriter:
    """The writer of a stream that keeps its checkpoint in that folder.

    A micro-batch writes files for every partition of the state. In a `file:` folder
    Spark's usual way (`FileContext`) starts a process whenever it looks whether a file
    is a link, several times for each file: most of the time of a small micro-batch.
    There the files go by `FileSystem`, which renames them the same way and looks for
    no links. Other file systems, and a session that names its own class, stay as
    they are.
    """
    spark = writer._spark
    local, held = _is_local(spark, checkpoint), spark.conf.get(_CHECKPOINT_FILES, None)
    if local and held is None:
        spark.conf.set(_CHECKPOINT_FILES, _BY_FILE_SYSTEM)
    elif not local and held == _BY_FILE_SYSTEM:
        spark.conf.unset(_CHECKPOINT_FILES)
    return writer.option("checkpointLocation", checkpoint)


def stored(df: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """Compute once into a table in the shared folder and go on from there.

    The result survives lost executors, it can be measured before it is used,
    and later uses read only the columns they need. A `folder` is overwritten;
    without one a new folder is taken.
    """
    folder = folder or new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
