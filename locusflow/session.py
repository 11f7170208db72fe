"""Session settings shared by tests, benchmark and command-line use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders made for local sessions without a checkpoint folder, by application.
_LOCAL: dict[str, str] = {}


def local_session(app: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the session names one.

    Only a local master without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    # The setting cannot be changed in a running session, so the folder is remembered here.
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="locusflow-")
    return _LOCAL[app]


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a Parquet table in the shared folder and read it back.

    Lineage ends there: losing an executor afterwards costs a re-read and not a
    recomputation, later plans see real sizes, and only needed columns are read.
    The caller's job owns the folder; nothing is deleted here.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/locusflow/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
