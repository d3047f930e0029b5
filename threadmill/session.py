"""What the package needs from a Spark session: fixed settings, a shared folder to write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession


# Times are rendered and read in UTC; of two equal keys in a JSON object the last one counts.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Put the settings in place that results depend on."""
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that comes in fewer splits than there are cores.

    A large input has more splits than the cluster has cores and passes through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """Deal rows out evenly to all cores, for narrow rows that are dear to work on.

    Splits do not tell how rows are spread: all of them may stand in one row group of a file.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, df.rdd.getNumPartitions()))


def in_few_tasks(df: DataFrame, rows: int, rows_per_task: int) -> DataFrame:
    """Work on about ``rows`` rows (counted before) in no more tasks than they are worth, one per core at least.

    The shuffle partitions of a session are meant for its tables; on a few rows most of them are empty, and
    many short rounds are then mostly the starting of tasks. More rows get more tasks.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own; a
    machine-local folder would be wrong on a cluster, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="threadmill-")
    context.setCheckpointDir(own)
    return own


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder name in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/threadmill/{label}-{uuid.uuid4().hex}"


# Folders that this process has written intermediate tables to.
_written: list[str] = []


def written_tables() -> list[str]:
    """Folders of the intermediate tables so far, oldest first."""
    return list(_written)


def discard(paths: list[str], unless_read_by: DataFrame) -> None:
    """Remove intermediate tables that nothing needs any more.

    The caller vouches for all DataFrames but ``unless_read_by``, whose tables stay.
    """
    spark = unless_read_by.sparkSession
    read = unless_read_by.inputFiles() if paths else []
    conf, fs = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        name = path.rstrip("/").rsplit("/", 2)[-2]  # unique, see fresh_dir
        if not any(name in f for f in read):
            place = fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def collect_garbage(spark: SparkSession) -> None:
    """Let the executors give memory back that is free but still held, as between two large stages."""
    tasks = spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).selectExpr("java_method('java.lang.System', 'gc') AS freed").collect()


def materialize(
    df: DataFrame, label: str, folder: str | None = None, observe: Observation | None = None,
    *metrics, small: bool = False,
) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder, and go on from there.

    Cuts the lineage with replicated files instead of executor-local blocks, so a lost
    executor costs nothing. A written table is compact, lets later steps read only the
    columns they use and tells them its exact size; rows known to be few (``small``) take
    the quicker way of a checkpoint, which is kept in the same shared folder.
    """
    spark = df.sparkSession
    shared = shared_dir(spark)
    out = df.observe(observe, *metrics) if observe is not None else df
    if small:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared)
        return out.checkpoint()
    path = f"{folder or fresh_dir(spark, label)}/{label}"
    _written.append(path)
    out.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
