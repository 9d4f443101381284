"""Tables in the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only on a single machine that names none."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stationlens-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    The shuffle files of the query that wrote it are let go, so that an operator of
    several steps holds those of one step at a time.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stationlens_path = path
    return out


def cached(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path``; made and written there if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete materialized tables that nothing will read again."""
    for df in frames:
        if path := getattr(df, "_stationlens_path", None):
            context = df.sparkSession.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context: their Python may not have it on its path."""
    context = spark.sparkContext
    if getattr(context, "_stationlens_shipped", False):
        return
    import pathlib
    import zipfile

    package = pathlib.Path(__file__).parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="stationlens-")) / "stationlens.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(path))
    context._stationlens_shipped = True
