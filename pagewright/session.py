"""Session helpers: a test session, table paths and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "pagewright", cpus: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PAGEWRIGHT_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own, and on a
    cluster, whose executors couldn't read one, it is an error."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="pagewright-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


_KEPT: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    """Persists a small table that a query reads several times, until ``release``."""
    _KEPT.append(df.persist())
    return df


def release() -> None:
    """Frees the tables that earlier queries kept; a result of theirs that is still read works them out again."""
    while _KEPT:
        _KEPT.pop().unpersist()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for clusters on which it isn't installed.

    The archive is served by the driver like any file of the application; nothing is read from a local folder elsewhere.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    folder = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="pagewright-")) / "pagewright.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(folder.rglob("*.py")):
            z.write(path, path.relative_to(folder.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
