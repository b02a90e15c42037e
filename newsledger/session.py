"""Session settings the jobs are written for, and reliable materialisation."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks partition counts, re-checks broadcast sizes at run time and splits skewed
# join partitions. Static shuffle partitions only bound the first guess.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and texts vary in size: batches to Python are cut by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "newsledger", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``; a local session may go without and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="newsledger-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the cluster's shared checkpoint folder.

    Used where recomputing would call a model again.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


_shipped: set[tuple[str, str]] = set()


def _package(folder: Path) -> tuple[str, list[tuple[str, bytes]]]:
    """A package's source files by their place in an archive, and a name that no other contents have."""
    files = [(str(p.relative_to(folder.parent)), p.read_bytes()) for p in sorted(folder.rglob("*.py"))]
    digest = hashlib.sha256()
    for place, content in files:
        digest.update(f"{place}:{len(content)}:".encode() + content)
    return f"{folder.name}-{digest.hexdigest()[:20]}.zip", files


def ship_packages(spark: SparkSession, *folders: str | Path) -> None:
    """Makes Python packages importable on the executors, each contents once per application.

    Every package is an archive of its own, named by its contents: any sets of folders may be shipped one after another.
    """
    context = spark.sparkContext
    for folder in map(Path, folders):
        name, files = _package(folder)
        if (context.applicationId, name) in _shipped:
            continue
        archive = Path(tempfile.mkdtemp(prefix="newsledger-code-")) / name
        with zipfile.ZipFile(archive, "w") as bundle:
            for place, content in files:
                bundle.writestr(zipfile.ZipInfo(place), content)
        context.addPyFile(str(archive))
        _shipped.add((context.applicationId, name))
