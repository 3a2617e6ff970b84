"""Session settings the engine relies on, and the folder it may write scratch tables to."""

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; sizes stay the cluster's business."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app="skytally", master=None, **conf) -> SparkSession:
    """A session for jobs, bench and tests. Dots in conf names are written as ``__``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for a table that has to be written between two steps.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session, where driver and executors share one disk, may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="skytally-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_dir` named, once what it held is used up."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's executors.

    Sends the sources once per application; workers that find the package on their own path
    lose nothing by it.
    """
    context = spark.sparkContext
    if getattr(context, "_skytally_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="skytally-")) / "skytally.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._skytally_shipped = True
