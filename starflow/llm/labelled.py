"""A bounded, documented sample of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import pick
from starflow.sources.workspace import Workspace

FOLDS = 5
_PLACES = 1 << 40


def fold(doc_id: Column) -> Column:
    """0..4: crc32 of the id as text; NULL counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    per_class: int,
    held_out_fold: int | None = None,
    workspace: Workspace,
) -> tuple[DataFrame, dict[int, int]]:
    """Stored (id, text, label) of at most ``per_class`` ids per class, and how many ids each class has.

    One row per id, so the sample is bounded whatever repeats: of several texts of one id the one with the
    smallest hash, and of contradicting labels the larger one.

    The ids are those with the smallest hashes, so they are a random sample that is the
    same on every run. Hashes so large that they cannot be among them are left out before the
    sort (a share that leaves twice as many as needed, on average). The ids are chosen from the
    labels alone and broadcast (2 * per_class ids), so the documents are not shuffled. Rows with a
    NULL id or label are no use here.
    """
    marks = pick(labels, id=doc_id, label=label).where("id IS NOT NULL AND label IS NOT NULL")
    marks = marks.select("id", (F.col("label") > 0).cast("int").alias("label"))
    if held_out_fold is not None:
        marks = marks.where(fold(F.col("id")) != held_out_fold)
    marks = workspace.store(marks.groupBy("id").agg(F.max("label").alias("label")), "marks")
    sizes = {r[0]: r[1] for r in marks.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("id"), F.lit(_PLACES))
    order = [place, F.col("id")]
    chosen = None
    for value in (0, 1):
        some = marks.where(F.col("label") == value)
        some = some.where(place < int(_PLACES * min(1.0, 2 * per_class / max(1, sizes.get(value, 0)))))
        some = some.orderBy(*order).limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    chosen = workspace.store(chosen, "chosen")
    rows = pick(docs, id=doc_id, text=text).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return workspace.store(rows.select("id", "text", "label"), "sample"), sizes
