"""Session factory, shipping this package to executors, and tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def get_session(app: str = "ledgerlens", **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` adds to or overrides the settings."""
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"} | conf
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package's source to Python workers, once an application, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(here)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(d, f), os.path.relpath(os.path.join(d, f), os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)  # copied to the driver's file server and fetched by every executor
    _shipped.add(app)


def scratch(spark: SparkSession) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; where that is unset, as in tests, a temporary one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written there and read back, so that its lineage ends and no executor's loss matters."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
