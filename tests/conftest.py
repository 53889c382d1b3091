import pytest
from pyspark.sql import SparkSession


def new_session():
    return (
        SparkSession.builder.master("local[8]")
        .appName("tripstream-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # On a local disk the default manager starts a process for each small file it writes.
        .config(
            "spark.sql.streaming.checkpointFileManagerClass",
            "org.apache.spark.sql.execution.streaming.checkpointing"
            ".FileSystemBasedCheckpointFileManager",
        )
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
