import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from the session's settings.

    Where none is set, a local session gets a temporary folder; on a cluster that is an error, since each executor would
    write to a disk of its own. The session's setting is left alone.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _local_root = _local_root or tempfile.mkdtemp(prefix="tripstream-")
    return _local_root


def _derived(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/tripstream/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a fresh folder for data that one query derives."""
    return f"{_derived(spark)}/{name}-{uuid.uuid4().hex}"


def remove_derived(spark: SparkSession) -> None:
    """Removes all that this application's queries have derived so far. Results that read from it can't be read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_derived(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
