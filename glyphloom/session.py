"""Session construction and the shared folder for tables written between steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "glyphloom") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, where that is unset, one of our own.

    Only a session without the setting (tests, a single machine) gets a temporary folder; it is
    removed when the driver's Python ends.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="glyphloom-")
        atexit.register(shutil.rmtree, base[len("file://") :], True)
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Gives the session's Python workers this package, once: tasks import what they run from it.

    Where the workers have it already, installed or on their path, this changes nothing."""
    sc = spark.sparkContext
    if getattr(sc, "_glyphloom_shipped", False):
        return
    sc._glyphloom_shipped = True
    base = shared_dir(spark).removeprefix("file://")
    folder = Path(base if "://" not in base else tempfile.mkdtemp(prefix="glyphloom-"))
    folder.mkdir(parents=True, exist_ok=True)
    package, target = Path(__file__).resolve().parent, folder / f"glyphloom-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    atexit.register(target.unlink, True)
    sc.addPyFile(str(target))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a table in the shared folder.

    Cuts the lineage: what is computed once is read again, also after executors are lost. Columnar
    and compressed, it takes less disk than checkpoint(). It stays until clear() or the program's end.
    """
    spark = df.sparkSession
    ship(spark)
    path = fresh_path(spark, name)
    forget_later(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def forget_later(spark: SparkSession, path: str) -> None:
    """Lets clear(), or the program's end, delete what is or will be at path."""
    if not _written:
        atexit.register(clear, spark)
    _written.append(path)


def clear(spark: SparkSession) -> None:
    """Deletes the tables written so far; results that aren't written elsewhere yet are lost with them."""
    while _written:
        path = _written.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may have ended
            return


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: repartitioned if its scan has fewer tasks than there are cores, as small or
    unsplittable files have; else as it is. For work on every row that costs more than a shuffle of it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def evenly(df: DataFrame) -> DataFrame:
    """The rows of an aggregate in as many tasks as a shuffle has, whatever their bytes: few and small rows
    would otherwise end in one task, also where each is costly."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
