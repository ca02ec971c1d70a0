"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks that run Python import it. Spark's own file server hands it out, so executors need no
    copy of their own; with ``--py-files`` or an installed package this changes nothing.
    """
    context = spark.sparkContext
    package = Path(__file__).parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="bikenet-")) / "bikenet.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def get_spark(app: str = "bikenet", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; cluster sizing stays with the cluster's own settings.

    Connector jars (object store, Kafka) are deployment matters: pass them with ``--packages``
    or as ``get_spark(**{"spark.jars.packages": ...})``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, where every executor can read and write.

    Only a local session may run without that setting; it gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="bikenet-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
