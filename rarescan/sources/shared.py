"""The shared folder for written intermediate tables.

A cluster names it in ``spark.checkpoint.dir``.  Tables written there outlive
the executor that wrote them, so a lost executor never forces a long recompute.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows that are blocks of many rows: by default Parquet looks at its buffers after every 100 of them only.
ROW_GROUP_BYTES = 8 << 20
SMALL_ROW_GROUPS = {
    "parquet.block.size": ROW_GROUP_BYTES,
    "parquet.block.size.row.check.min": 1,
    "parquet.page.size.row.check.min": 1,
}


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="rarescan-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/rarescan/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), blocks: bool = False) -> DataFrame:
    """Write once, read back: later passes scan only the columns they need.

    ``blocks``: the rows are large, so that tasks write and read row groups of a few megabytes.
    """
    path = new_path(df.sparkSession, name)
    options = {name: str(value) for name, value in SMALL_ROW_GROUPS.items()} if blocks else {}
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``materialize`` gave and nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
