"""Reading files under a contract."""

from __future__ import annotations

import functools
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.columns import ref, refs
from starflow.sources.contract import SchemaContract, check_header, normalize_columns
from starflow.sources.workspace import Workspace

CORRUPT = "_corrupt_record"


class EmptySourceError(ValueError):
    """A source that exists but holds no row."""


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    contract: SchemaContract,
    *,
    header: bool = True,
    corrupt_record: str | None = None,
) -> DataFrame:
    """CSV under an explicit schema: no inference pass, columns in contract order.

    ``path`` may be a file, a folder, a glob, or a list of these. With ``header``, names are read from
    the file, normalised and compared with the contract, so columns may come in any
    order and with stray blanks in their names; a header that does not fit, or a later
    file whose header differs from the first, is an error. A cell that does not parse
    is NULL. ``corrupt_record`` adds a column with the text of malformed rows.

    A missing path raises Spark's ``AnalysisException``.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if header:
        written = spark.read.option("header", True).csv(path).columns
        names = check_header(written, contract)
        reader = reader.option("header", True).option("enforceSchema", False)
    else:
        written = names = contract.names
    fields = [T.StructField(w, contract.schema[n].dataType, True) for w, n in zip(written, names)]
    if corrupt_record is None:
        df = reader.schema(T.StructType(fields)).csv(path)
        return normalize_columns(df).select(*refs(contract.names))
    fields.append(T.StructField(corrupt_record, T.StringType(), True))
    reader = reader.option("columnNameOfCorruptRecord", corrupt_record)
    df = reader.schema(T.StructType(fields)).csv(path)
    return normalize_columns(df).select(*refs([*contract.names, corrupt_record]))


def files_by_header(
    spark: SparkSession, path: str | list[str], *, max_headers: int = 1000
) -> dict[str, list[str]]:
    """Header line to the files that have it, both in order.

    The first line that is not blank is a file's header; a file without one has no rows and is left
    out. All files are scanned as lines, in tasks, and each leaves one row. The names of the files
    reach the driver, which has listed them anyway; more than ``max_headers`` different headers are
    an error.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    heads = (
        lines.where((F.col("start") == 0) & F.col("value").rlike(r"\S"))
        # Rows of a block come in file order, and only one block of a file starts at 0.
        .withColumn("place", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )
    groups: dict[str, list[str]] = {}
    for row in heads.orderBy("header", "file").toLocalIterator():
        groups.setdefault(row["header"], []).append(unquote(row["file"]))
        if len(groups) > max_headers:
            raise ValueError(f"more than {max_headers} different headers in {path}")
    return groups


def scan_csv_by_header(
    spark: SparkSession,
    path: str | list[str],
    contract: SchemaContract,
    *,
    corrupt_record: str | None = None,
) -> DataFrame:
    """``scan_csv`` of files whose headers differ in the order of columns or in blanks.

    Files with the same header are one scan, with its own projection to the contract's order; the
    scans are then one table. A header that does not fit the contract is an error that names a file.
    """
    scans = []
    for files in files_by_header(spark, path).values():
        names = [re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in files]
        try:
            scans.append(scan_csv(spark, names, contract, corrupt_record=corrupt_record))
        except ValueError as error:
            raise ValueError(f"{files[0]} and {len(files) - 1} more: {error}") from error
    if scans:
        return functools.reduce(DataFrame.unionAll, scans)
    fields = [T.StructField(f.name, f.dataType, True) for f in contract.schema]
    if corrupt_record is not None:
        fields.append(T.StructField(corrupt_record, T.StringType(), True))
    return spark.createDataFrame([], T.StructType(fields))


def scan_source(
    spark: SparkSession,
    path: str | list[str],
    contract: SchemaContract,
    *,
    header: bool | str = True,
    corrupt_record: str | None = None,
) -> DataFrame:
    """``scan_csv``, or ``scan_csv_by_header`` where ``header`` is "each"."""
    if header == "each":
        return scan_csv_by_header(spark, path, contract, corrupt_record=corrupt_record)
    if not isinstance(header, bool):
        raise ValueError(f"header is True, False or 'each', not {header!r}")
    return scan_csv(spark, path, contract, header=header, corrupt_record=corrupt_record)


def require_rows(df: DataFrame, source: str) -> None:
    """Raise if ``df`` is empty. Stops at the first row instead of counting."""
    if df.isEmpty():
        raise EmptySourceError(f"no rows in {source}; check the path and the format")


def split_malformed(stored: DataFrame, corrupt_record: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a scan that has been stored with its corrupt-record column.

    Storing first matters: a CSV scan only finds the bad cells of the columns it is
    asked for, so filtering the lazy scan would miss rows.
    """
    good = stored.where(ref(corrupt_record).isNull()).drop(corrupt_record)
    return good, stored.where(ref(corrupt_record).isNotNull())


def read_contract(
    spark: SparkSession,
    path: str,
    contract: SchemaContract,
    *,
    header: bool | str = True,
    on_malformed: str = "keep",
    workspace: Workspace | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(good, bad) rows of a CSV source; raises ``EmptySourceError`` if it has no row.

    ``header="each"`` reads the header of every file, so their columns may come in different orders.

    ``"keep"`` leaves rows with too few or too many cells, or with a cell that does not
    parse, in ``good`` with NULL in the bad cells; ``bad`` is then None. ``"quarantine"``
    moves them to ``bad``, with their text in ``_corrupt_record``.
    """
    if on_malformed == "keep":
        good = scan_source(spark, path, contract, header=header)
        require_rows(good, path)
        return good, None
    if on_malformed != "quarantine":
        raise ValueError(f"on_malformed is 'quarantine' or 'keep', not {on_malformed!r}")
    workspace = workspace or Workspace(spark)
    scan = scan_source(spark, path, contract, header=header, corrupt_record=CORRUPT)
    stored = workspace.store(scan, "scan")
    require_rows(stored, path)
    return split_malformed(stored)


def read_parquet(spark: SparkSession, path: str, contract: SchemaContract) -> DataFrame:
    """Parquet with the contract's columns, cast to its types and put in its order."""
    df = normalize_columns(spark.read.parquet(path))
    check_header(df.columns, contract)
    df = df.select(*[ref(f.name).cast(f.dataType).alias(f.name) for f in contract.schema])
    require_rows(df, path)
    return df


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with a header that reads back cell for cell: the writer would otherwise trim.

    ``compression`` is a codec of Spark's CSV writer; a file with gzip is read by one task.
    """
    (
        df.write.option("header", True)
        .option("compression", compression)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
