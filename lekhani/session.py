"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lekhani", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the operators rely on (AQE, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    is always honoured. Only a local master without the setting gets a
    temporary folder.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        spark.sparkContext.setCheckpointDir(shared)
    elif spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lekhani-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, unless their path has it."""
    root = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # a driver's file that Spark itself hands out
    archive = Path(tempfile.mkdtemp(prefix="lekhani-")) / "lekhani.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
