"""Intermediate tables in the cluster's shared folder.

A table that several later jobs read is written once and read back. That cuts the
lineage, keeps the columns prunable, and survives the loss of any executor. The
folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.sources.tables import read_bucketed, write_dealt

SHARED_DIR_CONF = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session: the setting, or else what the context was given.

    Only a ``local`` session may go without; it gets one temporary folder. Whether a path
    without a scheme, or with ``file:``, is a mount that all machines share cannot be told
    from here: on a cluster, name one that is.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None) or _context_dir(spark)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(
            f"set {SHARED_DIR_CONF} to a folder that the driver and all executors share"
        )
    app = spark.conf.get("spark.app.id", master)
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="starflow-")
    return _local_roots[app]


def _context_dir(spark: SparkSession) -> str | None:
    """The folder of ``SparkContext.setCheckpointDir``, without the part Spark adds to it."""
    given = spark.sparkContext.getCheckpointDir()
    return given and given.rsplit("/", 1)[0]


class Workspace:
    """A fresh folder for the intermediate tables of one run."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or shared_root(spark)}/starflow-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        """A path nobody has used yet."""
        return f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"

    def store(self, df: DataFrame, name: str, row_id: str | None = None, compression: str | None = None) -> DataFrame:
        """Write ``df`` as Parquet and return it read back.

        ``row_id`` adds a unique bigint per row. It is fixed at this write: every
        later read sees the same id on the same row. ``compression`` "zstd" takes fewer bytes, for
        tables as wide as the input; without it the session's codec is used.
        """
        if row_id is not None:
            df = df.withColumn(row_id, F.monotonically_increasing_id())
        path = self.folder(name)
        writer = df.write if compression is None else df.write.option("compression", compression)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def deal(self, df: DataFrame, name: str, columns: Sequence[str], number: int) -> DataFrame:
        """Write ``df`` into ``number`` buckets by the hash of ``columns`` and return it read back, known to be so dealt.

        No row is shuffled. The names of the columns may be any.
        """
        names = [f"c{i}" for i in range(len(df.columns))]
        keys = [names[df.columns.index(c)] for c in columns]
        path, plain = self.folder(name), df.toDF(*names)
        write_dealt(plain, path, keys, number)
        return read_bucketed(self.spark, path, plain.schema, keys, number, ordered=False).toDF(*df.columns)

    def remove(self) -> None:
        """Delete the folder. Tables that still read from it are gone with it."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)
