"""Session settings and cutting of lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "panelkit") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def durable(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder as Parquet and read it from there.

    With ``by`` each value of that column is a folder of its own, and a filter on it reads no
    other.

    For a small result that several later steps read: it is computed once, a lost
    executor does not lose it, and its size is known to the planner. Runs a job. The files
    lie under ``panelkit/<application id>``; :func:`clear` removes them.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; an error if it names none."""
    own = getattr(spark.sparkContext, "_panelkit_folder", None)
    folder = spark.conf.get("spark.checkpoint.dir", None) or own
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def with_folder(spark: SparkSession) -> SparkSession:
    """Name a folder for a session on this machine that has none, as tests and trials do.

    The setting itself cannot be changed in a running session, so it is noted beside it.
    """
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not hasattr(sc, "_panelkit_folder"):
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            sc._panelkit_folder = tempfile.mkdtemp(prefix="panelkit-")
    return spark


def clear(spark: SparkSession) -> None:
    """Delete all that this application wrote to the shared folder; DataFrames on it are then unusable."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_folder(spark: SparkSession) -> str:
    """The folder for what this application writes and :func:`clear` deletes."""
    return f"{checkpoint_folder(spark)}/panelkit/{spark.sparkContext.applicationId}"
