"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Sequence
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(app: str = "shelflight", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on and UTC times; ``settings`` win over defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, which all executors see: the checkpoint folder, or else the warehouse."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows held by the driver as a table whose size Spark knows.

    It comes from Arrow, so while it is small it is a local relation, which a join
    broadcasts by its own threshold; a large one is sent to the executors.
    """
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(struct)
    arrow = to_arrow_schema(struct)
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=struct)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/shelflight/{name}-{uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def settle(df: DataFrame, name: str = "table", rows: int = 0) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the optimiser the true
    size: a join with the result is broadcast only when the files are smaller
    than ``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise.  With
    ``rows`` a file holds no more of them, which bounds what is buffered of long rows.
    """
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    # The archive is built on the driver; Spark copies it to every executor.
    folder = tempfile.mkdtemp(prefix="shelflight-py-")
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
