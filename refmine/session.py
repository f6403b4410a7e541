"""Session settings, table access and the shared folder for cut lineages."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from refmine import storage

_OWN_DIR: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app: str = "refmine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the library works well with; ``conf`` comes before them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Python stages take long for each byte, and texts pack tenfold in Parquet: smaller splits keep all cores busy.
        "spark.sql.files.maxPartitionBytes": "32m",
        "spark.sql.files.openCostInBytes": "262144",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """This application's own folder in the one that all executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset a temporary folder is made, which only a local master may use.
    ``tidy`` removes it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return f"{path.rstrip('/')}/refmine-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN_DIR:
        _OWN_DIR[key] = "file://" + tempfile.mkdtemp(prefix="refmine-")
    return _OWN_DIR[key]


def tidy(spark: SparkSession) -> None:
    """Remove this application's folder with all cut lineages; tables that still read them are void."""
    storage.delete(spark, shared_dir(spark))
    _OWN_DIR.pop(spark.sparkContext.applicationId, None)


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once a session; operators with Python stages call it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="refmine-ship-")) / "refmine.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    # Spark's own file server hands it to every executor.
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def ship_file(spark: SparkSession, path: str) -> None:
    """Send a small file (a vocabulary, say) to every executor, once a session; workers find it by ``shipped_file``."""
    key = spark.sparkContext.applicationId + path
    if key not in _SHIPPED:
        spark.sparkContext.addFile(path)
        _SHIPPED.add(key)


def shipped_file(path: str) -> str:
    """Where a file sent by ``ship_file`` lies on this machine; on the driver the path itself."""
    if getattr(SparkFiles, "_is_running_on_worker", False):
        own = SparkFiles.get(path.rsplit("/", 1)[-1])
        if Path(own).exists():
            return own
    return path


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    It cuts the lineage as ``checkpoint()`` does, but evaluates the plan only once,
    keeps the columnar layout, and survives the loss of any executor. ``partition_by``: a
    column of few values, whose filters then read their own files only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
