"""Exact duplicates, with the heavy hitters split off.

A frequent text would send all its copies to one task. So the frequent digests are found
first, with Spark's frequent-items aggregate: a Misra-Gries summary (a fixed number of
counters per task, decremented together when they run out, merged on the way up), which
cannot miss a digest above its error bound and costs no shuffle of rows. Its candidates
are then verified: counted exactly, with the winning row of each. There are at most
HOT_DIGESTS of them, so they are broadcast, and their copies are settled where they are
read. Every other digest holds less than 1/HOT_DIGESTS of the rows, or is one of those the
summary let go below its bound, and takes the ordinary shuffle.

The whole path is built-in functions.

Defined results: NULL text counts as the empty text. The row with the largest id stays,
NULL ids being smaller than any other; of rows that share id and text any one stays. An
empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.functions.columns import ref
from starflow.llm.rows import fresh, pick
from starflow.sources.workspace import Workspace

# Most digests that are broadcast (about 100 bytes each), and the counters per task.
HOT_DIGESTS = 2048
COUNTERS = 16384


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text in lower-case hexadecimal; NULL as the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def frequent_digests(rows: DataFrame, hot: int = HOT_DIGESTS) -> DataFrame:
    """(digest, n, top): verified counts and winning rows of at most ``hot`` digests.

    ``rows`` has digest, id and row; ``top`` is the winner as (id, row).
    """
    summary = rows.agg(
        F.expr(f"approx_top_k(digest, {int(hot)}, {COUNTERS})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    )
    found = summary.select(F.explode("top").alias("item"), "total")
    least = F.greatest(F.lit(2), F.ceil(F.col("total") / hot))
    candidates = found.where(F.col("item.count") >= least).select("item.item", "total")
    candidates = candidates.select(F.col("item").alias("digest"), least.alias("least"))
    counted = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("id", "row")).alias("top"),
        F.first("least").alias("least"),
    )
    return counted.where("n >= least").select("digest", "n", "top")


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    hot: int = HOT_DIGESTS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    workspace = workspace or Workspace(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text).select("id", text_digest(F.col("text")).alias("digest"))
    rows = workspace.store(rows, "digests", row_id="row")
    winners = workspace.store(frequent_digests(rows, hot), "frequent")

    marked = rows.join(F.broadcast(winners), "digest", "left")
    same = Window.partitionBy("digest")
    rare = (
        marked.where(F.col("n").isNull())
        .withColumn("n", F.count(F.lit(1)).over(same))
        .withColumn("top", F.max(F.struct("id", "row")).over(same))
    )
    settled = marked.where(F.col("n").isNotNull()).unionByName(rare)
    return settled.select(
        F.col("id").alias(doc_id),
        F.col("top.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    hot: int = HOT_DIGESTS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``docs`` with one row per text, all columns unchanged.

    Copies of frequent texts are removed where they are read; what is left is shuffled
    once by digest.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    narrow = pick(docs, id=doc_id, text=text).select(
        "id", text_digest(F.col("text")).alias("digest"), F.lit(0).alias("row")
    )
    narrow = workspace.store(narrow, "digests")
    winners = workspace.store(frequent_digests(narrow, hot), "frequent")

    digest, best, place = (fresh(docs, c) for c in ("_digest", "_best", "_place"))
    best_rows = winners.select(
        F.col("digest").alias(digest), F.struct(F.col("top.id").alias("id")).alias(best)
    )
    tagged = docs.withColumn(digest, text_digest(ref(text)))
    left = tagged.join(F.broadcast(best_rows), digest, "left").where(
        ref(best).isNull() | ref(doc_id).eqNullSafe(ref(best)["id"])
    )
    newest = Window.partitionBy(ref(digest)).orderBy(ref(doc_id).desc_nulls_last())
    ranked = left.withColumn(place, F.row_number().over(newest))
    return ranked.where(ref(place) == 1).drop(digest, best, place)
