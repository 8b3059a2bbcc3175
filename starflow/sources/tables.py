"""Writing the finished tables, with a manifest of what can be read back."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.columns import ref, refs
from starflow.functions.jobs import run_together

MANIFEST_SCHEMA = "table string, rows bigint, bytes bigint, path string"
# How NULL is written in a CSV table. A text that is just this cannot be told from NULL, so
# writing it is an error.
NULL_MARK = "\\N"
# Every cell is quoted and a quote is doubled, so blanks, line breaks, quotes, backslashes and
# the empty text come back as they were. Reader and writer use the same options.
CSV_OPTIONS = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "lineSep": "\n",
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# CSV as it is, or each file with gzip; Spark tells them apart by name when it reads.
CSV_CODECS = {"csv": "none", "csv.gz": "gzip"}


# Files a task may hold open for the folders or buckets it writes; more and it sorts its rows first.
_OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"
_OPEN_FILES = threading.Lock()


class UnwritableTextError(ValueError):
    """A text that a CSV table could not give back."""


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write one table from the executors, replacing what is there.

    With ``partition_by`` the rows are first brought together by those columns, so a
    folder gets few files; a value that holds much of the table is split over tasks. A
    carriage return, or a text that is the NULL mark, cannot be kept by CSV and raises
    ``UnwritableTextError`` once the table is written.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    codec = CSV_CODECS.get(fmt)
    if codec:
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        lost = [(ref(c) == NULL_MARK) | ref(c).contains("\r") for c in texts]
        seen = Observation()
        bad = reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in lost], F.lit(False))
        df = df.observe(seen, F.count_if(bad).alias("bad"))
    elif fmt != "parquet":
        raise ValueError(f"fmt is 'parquet', 'csv' or 'csv.gz', not {fmt!r}")
    writer = df.write.mode("overwrite").format("csv" if codec else fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.options(**CSV_OPTIONS) if codec else writer
    writer.option("compression", codec or "zstd").save(path)
    if codec and seen.get["bad"]:
        raise UnwritableTextError(f"{path}: CSV cannot keep {seen.get['bad']} texts; use Parquet")


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table as ``write_table`` left it. A CSV row that does not fit is an error."""
    reader = spark.read.schema(schema).format("csv" if fmt in CSV_CODECS else fmt)
    if fmt in CSV_CODECS:
        reader = reader.options(**CSV_OPTIONS).option("mode", "FAILFAST")
    return reader.load(path).select(*refs(schema.names))


def write_dealt(df: DataFrame, path: str, columns: Sequence[str], number: int) -> None:
    """Parquet dealt into ``number`` buckets by the hash of ``columns``, where the rows lie.

    Nothing is shuffled: every task writes its own file of each bucket, all open at once, so no task sorts its rows.
    """
    spark, name = df.sparkSession, f"starflow_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").mode("overwrite").option("path", path).option("compression", "zstd")
    with _OPEN_FILES:
        before = spark.conf.get(_OPEN_FILES_CONF, None)
        spark.conf.set(_OPEN_FILES_CONF, str(number))
        try:
            writer.bucketBy(number, *columns).saveAsTable(name)
        finally:
            spark.conf.unset(_OPEN_FILES_CONF) if before is None else spark.conf.set(_OPEN_FILES_CONF, before)
    spark.sql(f"DROP TABLE {name}")


def write_bucketed(df: DataFrame, path: str, columns: Sequence[str], number: int) -> None:
    """Parquet dealt into ``number`` buckets by the hash of ``columns``, one sorted file each.

    The entry that Spark's catalog needs for the write goes at once; the files stay.
    """
    name = f"starflow_{uuid.uuid4().hex}"
    dealt = df.repartition(number, *refs(columns))
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(number, list(columns)).sortBy(list(columns)).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str],
    number: int,
    *,
    ordered: bool = True,
) -> DataFrame:
    """What ``write_bucketed`` left, known to be dealt by ``columns``; ``ordered=False`` for ``write_dealt``."""
    name = f"starflow_{uuid.uuid4().hex}"
    cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in columns)
    order = f"SORTED BY ({keys}) " if ordered else ""
    spark.sql(
        f"CREATE TABLE {name} ({cells}) USING parquet CLUSTERED BY ({keys}) {order}"
        f"INTO {number} BUCKETS LOCATION '{path}'"
    )
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the data files under ``path``; lists the files, does not open them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def write_tables(
    tables: Mapping[str, DataFrame],
    directory: str,
    fmt: str = "parquet",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Write ``directory/<table>`` for every table.

    Returns the manifest (table, rows, bytes, path). Rows are counted in what is read back.
    """
    if not tables:
        raise ValueError("no table given")
    spark = next(iter(tables.values())).sparkSession

    def write(name: str) -> tuple[str, int, int, str]:
        path = f"{directory.rstrip('/')}/{name}"
        write_table(tables[name], path, fmt, (partition_by or {}).get(name, ()))
        rows = read_table(spark, path, tables[name].schema, fmt).count()
        return name, rows, stored_bytes(spark, path), path

    entries = run_together(spark, write, list(tables))
    return spark.createDataFrame(entries, MANIFEST_SCHEMA)
