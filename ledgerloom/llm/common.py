"""What the operators share: the scratch folder, materialised stages and input guards."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only where it is unset (tests on one machine) a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _own_folder:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        base = _own_folder[app]
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder, deleted when the driver's JVM ends."""
    path = f"{scratch_folder(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table in the scratch folder and read it back, so that a lost executor costs no recomputation of what stands before it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key that holds more than this part of all rows is hot; so there are at most as many hot keys.
HOT_PART = 1000


def join_one(rows: DataFrame, firsts: DataFrame, keys: list[str], members: str) -> DataFrame:
    """``rows`` with the one row of ``firsts`` that has the same ``keys``; rows without one go.

    ``members`` counts the rows of each key. A hot key's row, of which there are ``HOT_PART`` at most, is broadcast, so that no task gets all of its rows; the others are shuffled. Both inputs are read twice: pass written tables.
    """
    total = firsts.agg(F.sum(members)).first()[0] or 0
    hot = F.broadcast(firsts.filter(F.col(members) * HOT_PART > total))
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(firsts.filter(F.col(members) * HOT_PART <= total), keys))


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def text_of(column: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def partitions_for(spark: SparkSession, size: float, each: float) -> int:
    """Partitions for ``size`` bytes of at most ``each``; never fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-size // each)), 1)
