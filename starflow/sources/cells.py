"""Which cell of a malformed CSV row is bad, and why.

One scan reads every cell as text. Each is then cast on its own, so a bad cell costs only itself:
the row stays, with NULL there, and carries a list of what was wrong.

Defined results: an empty cell is NULL and not bad. Outer blanks around a number are accepted. A row
that ends early misses each of the columns behind its last cell; one that goes on has one entry
without a column. Lines are cut where the CSV reader cuts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.columns import ref, refs
from starflow.sources.contract import SchemaContract, check_header

BAD_CELLS = "_bad_cells"
MISSING, EXTRA = "missing cell", "more cells than columns"
_LINE = "_line"
# A quoted part of a line, with what a backslash hides in it.
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def _cells_in(line: Column) -> Column:
    """How many cells a line has: its commas outside quotes, and one."""
    return F.regexp_count(F.regexp_replace(line, _QUOTED, ""), F.lit(",")) + 1


def _entry(column: Column, text: Column, reason: Column) -> Column:
    return F.struct(column.alias("column"), text.alias("text"), reason.alias("reason"))


def scan_cells(
    spark: SparkSession, path: str | list[str], contract: SchemaContract, *, header: bool = True
) -> DataFrame:
    """The contract's columns, and ``_bad_cells``: an array of (column, text, reason) per row.

    The array is empty for a good row. A reason is ``not int`` (or another type), ``missing cell``
    or ``more cells than columns``.
    """
    # A pruned parser does not count the cells of a line.
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
    reader = reader.option("columnPruning", False)
    names = contract.names
    if header:
        written = spark.read.option("header", True).csv(path).columns
        names = check_header(written, contract)
        # All files must have the header of the first: the reader compares the names.
        reader = reader.option("header", True).option("enforceSchema", False)
    else:
        written = names
    if any(n in (BAD_CELLS, _LINE) for n in names):
        raise ValueError(f"a column may not be called {BAD_CELLS} or {_LINE}")
    fields = [T.StructField(w, T.StringType()) for w in [*written, _LINE]]
    raw = reader.schema(T.StructType(fields)).csv(path).toDF(*names, _LINE)
    # The reader keeps a line's text only if its number of cells is wrong: no text fails as text.
    line = F.col(_LINE)
    raw = raw.withColumn("_n_cells", F.when(line.isNotNull(), _cells_in(line)))
    n = F.col("_n_cells")

    kinds = {f.name: f.dataType for f in contract.schema}
    checks = []
    for place, name in enumerate(names):
        text, kind = ref(name), kinds[name]
        absent = F.when(n <= place, _entry(F.lit(name), F.lit(None).cast("string"), F.lit(MISSING)))
        if not isinstance(kind, T.StringType):
            wrong = text.isNotNull() & text.try_cast(kind).isNull()
            reason = F.lit(f"not {kind.simpleString()}")
            absent = absent.when(wrong, _entry(F.lit(name), text, reason))
        checks.append(absent)
    over = _entry(F.lit(None).cast("string"), line, F.lit(EXTRA))
    checks.append(F.when(n > len(names), over))
    bad = F.filter(F.array(*checks), lambda e: e.isNotNull())
    typed = [ref(f.name).try_cast(f.dataType).alias(f.name) for f in contract.schema]
    return raw.select(*typed, bad.alias(BAD_CELLS))


def bad_cell_counts(cells: DataFrame) -> DataFrame:
    """(column, reason, cells) over all rows; partial counts are made before the shuffle."""
    entries = cells.select(F.explode(ref(BAD_CELLS)).alias("e")).select("e.column", "e.reason")
    return entries.groupBy(*refs(["column", "reason"])).agg(F.count(F.lit(1)).alias("cells"))
