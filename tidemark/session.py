"""Session construction and shared-folder handling."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold for every Tidemark session. Nothing here depends on the size of the data:
#: partition counts follow AQE, which coalesces small shuffles and splits skewed ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
}


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session with the library's defaults; keyword arguments override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once a context, so that they need not find it on a path."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tidemark-")  # the driver's own, as the context hands the file out from it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    place = os.path.join(folder, "tidemark.zip")
    with zipfile.ZipFile(place, "w") as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, str(Path(root.name, file.relative_to(root))))
    context.addPyFile(place)
    context._tidemark_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, where no other machine has to read
    it, is a folder chosen if that is unset; elsewhere its absence is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    if not folder:
        folder = os.path.join(tempfile.gettempdir(), "tidemark-checkpoints")
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget its lineage (survives a lost executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
