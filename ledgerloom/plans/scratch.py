"""Relations written once and read several times, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, whose files go when the driver's JVM ends. Only where the setting is absent and the master is local a temporary folder is used."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _own_folder:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        base = _own_folder[app]
    path = f"{base.rstrip('/')}/ledgerloom/{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the scratch folder, read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
