"""Session defaults and the scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What the streams of this library run with. Operators per record need the state
# store; sessions are merged within a task before they are shuffled.
STREAM_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Rows go to Python and back in batches of so many. A limit in bytes would be worked out anew
    # with each row, which takes longer than handing it over.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1),
}
# What a stream runs with, besides, that nobody will look back on. Of the state two
# micro-batches are kept, which is what going on after a failure takes; a task that is done leaves
# its state in the checkpoint alone, and a micro-batch none of its shuffle's files.
LEAN_DEFAULTS = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.ratioExtraSpaceAllowedInCheckpoint": "0",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# What every session of this library starts from.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    **{k: v for k, v in STREAM_DEFAULTS.items() if ".streaming." in k},
}


def build_session(app: str = "roadpulse", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` overrides the defaults.

    Sizes that depend on the cluster (shuffle partitions, memory, checkpoint
    folder) are left to whoever submits the job.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local master, where all tasks
    run on this machine, may fall back on a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix=f"roadpulse-{label}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    return f"{root.rstrip('/')}/roadpulse-{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: its lineage ends there."""
    path = f"{scratch_dir(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
