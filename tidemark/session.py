"""Session factory and the one place where lineage is cut."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch between Spark and Python; a task holds a few batches.
BATCH_BYTES = 8 << 20
#: Estimated sizes beyond this are given up when lineage is cut.
LARGEST_ESTIMATE = (1 << 63) - 1

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Vector sums of long vectors are object aggregates; keep them hashed beyond 128 groups.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Create (or reuse) a session.

    ``shuffle_partitions`` is only the upper number adaptive execution starts from; it
    coalesces small partitions by size at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def local_session(cpus: int | None = None, memory: str = "8g", **conf: str) -> SparkSession:
    """A ``local[n]`` session for tests and benchmarks."""
    cpus = cpus or os.cpu_count() or 4
    return build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": memory,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Small tables on all cores: splits may be smaller than the default 4 MB.
            "spark.sql.files.openCostInBytes": str(256 * 1024),
            **conf,
        },
    )


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per session, and its batches small.

    Batches are bounded by bytes: 10,000 long texts at once would be copied several times in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if any(Path(f).name == "tidemark.zip" for f in context.listFiles):
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="tidemark-package-")) / "tidemark"
    context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))


def _checkpoint_folder(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only local sessions without it get one of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        _checkpoint_folder(spark)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of a frame, from its plan."""
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder; survives the loss of executors.

    A checkpoint keeps the estimated size of its plan, and a join multiplies those of its sides. In a
    loop of joins the estimate's digits double with every round, until they fill the driver. So an
    estimate beyond what a long holds, which says nothing any more, becomes Spark's default.
    """
    spark = df.sparkSession
    _checkpoint_folder(spark)
    checked = df.checkpoint(eager=True)
    if estimated_bytes(checked) <= LARGEST_ESTIMATE:
        return checked
    rows, schema = checked._jdf.toJavaRDD(), checked._jdf.schema()
    return DataFrame(spark._jsparkSession.createDataFrame(rows, schema), spark)


def hadoop_path(spark: SparkSession, path: str):
    """Path and file system objects of any storage Spark can read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total size of a file or folder; 0 when it does not exist."""
    target, fs = hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0
