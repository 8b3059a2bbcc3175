"""Helpers shared by the text operators: column choice, row keys, Arrow slices of text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starflow.functions.columns import ref, require_columns

# Fixed value: a word is a run of other characters than these six, in every contract.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# A measured lookup is broadcast up to this size. Smaller than the library's default,
# because the driver builds the broadcast and may have little memory.
BROADCAST_BYTES = 16 * 1024 * 1024
# Text handled at once inside a task, so that numpy's temporary arrays stay small.
SLICE_BYTES = 2 * 1024 * 1024


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pick(docs: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, renamed, so that no other column can clash."""
    require_columns(docs, list(names.values()))
    return docs.select(*[ref(source).alias(name) for name, source in names.items()])


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a document by id and text. Equal rows share it."""
    return F.xxhash64(doc_id, doc_id.isNull(), text)


def keep_rows(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept.key``; of equal rows one.

    One shuffle of the documents: the row number reuses the partitioning and the sort
    of the join, and no key has more rows than one document has exact repeats.
    """
    key, n = fresh(docs, "_key"), fresh(docs, "_n")
    keyed = docs.withColumn(key, row_key(ref(doc_id), ref(text)))
    chosen = kept.select(F.col("key").alias(key))
    one = F.row_number().over(Window.partitionBy(ref(key)).orderBy(ref(key)))
    return keyed.join(chosen, key, "left_semi").withColumn(n, one).where(ref(n) == 1).drop(key, n)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; NULL becomes the empty text. No decoding takes place."""
    large = pa.types.is_large_string(column.type)
    return [b or b"" for b in column.cast(pa.large_binary() if large else pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of text; a document is never split."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows == 0:
            continue
        mean = max(1, column.nbytes // batch.num_rows)
        step = max(1, SLICE_BYTES // mean)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_texts(
    docs: DataFrame, fn: Callable[[pa.RecordBatch, list[bytes]], list], schema: str
) -> DataFrame:
    """Rows made by ``fn(batch, texts)``, which returns one Arrow array per column."""
    names = StructType.fromDDL(schema).names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays(fn(batch, texts), names)

    return docs.mapInArrow(run, schema)
