"""Session helpers: a local session, and where durable intermediates go."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWNED: list[str] = []


def _own_folder() -> str:
    """One temporary folder of this process, removed when it ends."""
    if not _OWNED:
        _OWNED.append(tempfile.mkdtemp(prefix="corpuskit-"))
        atexit.register(shutil.rmtree, _OWNED[0], ignore_errors=True)
    return _OWNED[0]


def local_session(cores: str = "8", app: str = "corpuskit") -> SparkSession:
    """Single-machine session used by the tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.path.join(_own_folder(), "shared"))
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """This application's folder for intermediates, under the one ``spark.checkpoint.dir`` names.

    Only a local session may run without the setting; it then gets a folder of its own that
    goes with the process. On a cluster a machine-local folder would vanish with its
    executor, so the missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = _own_folder()
    return os.path.join(configured, f"corpuskit-{spark.sparkContext.applicationId}")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the application's folder."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Cuts the lineage, survives lost executors, and unlike a row checkpoint the
    Parquet copy lets later passes read only the columns they use. An action.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def evaluated_once(df: DataFrame, kept: list[str], *columns: Column) -> DataFrame:
    """``kept`` and these columns, named, whose expressions no later step repeats.

    A plain projection is merged into the filters and projections above it, once per use; a
    generator is not.
    """
    return df.select(*kept, F.explode(F.array(F.struct(*columns))).alias("_once")).select(*kept, "_once.*")


def remove_intermediates(spark: SparkSession) -> None:
    """Deletes what this application has written by :func:`durable` and :func:`new_path`.

    For the end of a run, when all results are stored: DataFrames that still read
    intermediates cannot be used afterwards.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
