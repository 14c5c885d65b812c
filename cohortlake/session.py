"""Session settings the plans rely on, and the shared folder of the cluster."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Joins of a fact with users or courses keep one row per fact, so a hot user or
# course stays hot in the shuffle: adaptive execution splits such partitions,
# also where that costs one more shuffle below a later aggregate.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Shuffles start from partitions of about this much stored input; adaptive execution
# joins the small ones afterwards.
_INPUT_PER_PARTITION = 64 * 1024 * 1024


_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_UNPACKED = "spark.sql.sources.fileCompressionFactor"
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SCANNED = "spark.sql.files.maxPartitionBytes"


def configure(spark: SparkSession, input_bytes: int = 0, unpacked: int = 1) -> SparkSession:
    """Apply the runtime SQL settings to a session and return it.

    With the size of the input the initial number of shuffle partitions grows
    with it; the session's own number stays the least. ``unpacked`` is how many
    bytes of rows a stored byte becomes, also where Spark judges from the size
    of files whether a table is small enough to broadcast. Shuffled bytes unpack
    alike, so partitions are joined up to as much less of them, and files are read in
    pieces as much smaller: a task's rows stay bounded as the input grows.
    """
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = input_bytes * unpacked // _INPUT_PER_PARTITION
    spark.conf.set(_PARTITIONS, str(max(least, wanted)))
    spark.conf.set(_UNPACKED, str(float(unpacked)))
    own = spark.sparkContext.getConf()
    for key in (_ADVISED, _SCANNED):
        size = str(_INPUT_PER_PARTITION // unpacked) if unpacked > 1 else own.get(key, None)
        if size is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, size)
    return spark


def partitions(spark: SparkSession) -> int:
    """The number of partitions shuffles of a configured session start from."""
    return int(spark.conf.get(_PARTITIONS))


def like(spark: SparkSession) -> SparkSession:
    """A new session with settings of its own, sized like a configured one."""
    new = configure(spark.newSession())
    for key in ("spark.sql.shuffle.partitions", _PARTITIONS, _UNPACKED, _ADVISED, _SCANNED):
        new.conf.set(key, spark.conf.get(key))
    return new


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder with all in it, if it is there."""
    files, hadoop_path = _file_system(spark, path)
    files.delete(hadoop_path, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.getFileStatus(hadoop_path).isDirectory()


def stored_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and change time of a file or folder."""
    files, hadoop_path = _file_system(spark, path)
    content = files.getContentSummary(hadoop_path)
    changed = files.getFileStatus(hadoop_path).getModificationTime()
    return content.getLength(), content.getFileCount(), changed


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (tests, local mode) a new temporary
    folder is chosen and remembered on the session.
    """
    for lookup in (spark.conf.get, spark.sparkContext.getConf().get):
        root = lookup("spark.checkpoint.dir", None)
        if root:
            return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="cohortlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def run_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses.

    All paths of an application share a folder, which can go once it has ended.
    """
    application = spark.sparkContext.applicationId
    return os.path.join(
        shared_root(spark), "cohortlake", application, f"{name}-{uuid.uuid4().hex}"
    )
