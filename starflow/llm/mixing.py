"""Mixing sources to target weights, in words.

Every row gets a hash-random key from its id. The rows are range-partitioned and ordered by
(source, key); sums per partition and source, added up in partition order, give the words
before every partition, and a running sum inside the one partition where a source's
budget ends gives the exact cut. A source whose budget is above its size is repeated: whole
epochs first, then the part up to the cut. The whole path is built-in functions, and no
step gathers a source in one task.

Defined results: NULL text has no words. NULL is a source of its own, last in order. The row
at the cut gives only its first words, so that the budget is met exactly. Rows that share id and
size are told apart by a row number fixed at the first write, so one row per source is cut; the mix
of whole documents tells them apart by their text, and equal documents there share the words left for them
evenly, rounded down. An empty table gives an empty
result. Other columns are ignored, or carried on unchanged by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.rows import BROADCAST_BYTES, WORD_PATTERN, pick, word_count
from starflow.operators.keys import number_by_order
from starflow.operators.lookup import attach
from starflow.sources.workspace import Workspace

WEIGHTS = (5, 2, 1)  # by place of the source, repeating
SHARE = 1.5  # words of the mix per word of the input
MOST_EPOCHS = 2  # no source is taken more often
SEED = "mix"
_CUT = ("target", "source_size", "epochs", "cut_key", "cut_size", "cut_tie", "cut_words")


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    """A key that looks random but depends on the id alone, so reruns agree."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: int, workspace: Workspace
) -> DataFrame:
    """(source, pos, source_size, target) from rows of (source, size).

    Shares follow the weights; what is above ``most`` times a source's size is dealt out
    again, until none is above. Only two sums per round reach the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = number_by_order(totals, [F.col("source").asc_nulls_last()], "pos", workspace)
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(cycle, ((F.col("pos") - 1) % len(weights) + 1).cast("int"))
    placed = workspace.store(placed.withColumn("weight", weight), "sources")

    most_words = F.col("source_size") * most
    total = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = float("inf"), -1
    while True:  # each round caps at least one source more, or is the last
        full = most_words < F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        n, words, open_weight = placed.agg(
            F.count(F.when(full, 1)),
            F.coalesce(F.sum(F.when(full, most_words)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped:
            break
        capped = n
        level = (share * total - words) / open_weight if open_weight else 0.0
    target = F.least(most_words.cast("double"), F.lit(level) * F.col("weight"))
    return placed.select("source", "pos", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
    ties: str = "row",
    workspace: Workspace | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (id, source, size, key, tie, pos) and, per source, where it is cut.

    ``ties``: rows of one id and size are ordered by a stored row number (``"row"``), or by a hash of
    their text (``"text"``), which can be found again in the documents.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text, source=source).select(
        "id", "source", word_count(F.col("text")).alias("size"), mix_key(F.col("id"), seed).alias("key"),
        *([F.xxhash64("text").alias("tie")] if ties == "text" else []),
    )
    rows = workspace.store(rows, "sizes", row_id="tie" if ties == "row" else None)
    sources = workspace.store(source_targets(rows, weights, share, most, workspace), "targets")
    rows = attach(
        rows, sources, ["source"], ["pos"], null_safe=True, broadcast_bytes=BROADCAST_BYTES
    )
    ordered = workspace.store(
        rows.repartitionByRange("pos", "key", "size", "tie").withColumn("part", F.spark_partition_id()),
        "ordered",
    )

    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    goals = sources.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "rest", budget - F.col("epochs") * F.col("source_size")
    )
    # One row per source and partition: prefix sums over partitions, not over rows.
    parts = ordered.groupBy("pos", "part").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("pos").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    ends = (
        parts.join(goals.select("pos", "rest"), "pos")
        .where("before <= rest AND rest < before + words")
        .select("pos", "part", (F.col("rest") - F.col("before")).alias("inner"))
    )
    ends = workspace.store(ends, "ends")
    # The one partition of each source in which its budget ends.
    last = ordered.join(ends, ["pos", "part"]).groupBy("pos", "key", "size", "tie", "inner").agg(
        F.count(F.lit(1)).alias("copies")
    )
    words = F.col("size") * F.col("copies")
    running = Window.partitionBy("pos").orderBy("key", "size", "tie").rowsBetween(
        Window.unboundedPreceding, -1
    )
    cut = (
        last.withColumn("before", F.coalesce(F.sum(words).over(running), F.lit(0)))
        .where((F.col("before") <= F.col("inner")) & (F.col("inner") < F.col("before") + words))
        .select(
            "pos",
            F.col("key").alias("cut_key"),
            F.col("size").alias("cut_size"),
            F.col("tie").alias("cut_tie"),
            F.floor((F.col("inner") - F.col("before")) / F.col("copies")).alias("cut_words"),
        )
    )
    cuts = workspace.store(goals.drop("rest").join(cut, "pos", "left"), "cuts")
    return ordered, cuts


def _partial_words(key: Column, size: Column, tie: Column) -> Column:
    """Words taken in the last, partial epoch, beside the columns of the cut."""
    place, cut = F.struct(key, size, tie), F.struct("cut_key", "cut_size", "cut_tie")
    words = F.when(place < cut, size).when(place == cut, F.col("cut_words")).otherwise(0)
    return F.when(F.col("cut_key").isNotNull(), words).otherwise(0).cast("bigint")


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    **options,
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes from the row, repeats included.
    """
    ordered, cuts = mix_plan(docs, doc_id, text, source, **options)
    rows = attach(ordered, cuts, ["pos"], _CUT, broadcast_bytes=BROADCAST_BYTES)
    partial = _partial_words(F.col("key"), F.col("size"), F.col("tie"))
    return rows.select(
        F.col("id").alias(doc_id),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + partial).alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it was."""
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD_PATTERN), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mix_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    n_chars: str = "n_chars",
    *,
    seed: str = SEED,
    workspace: Workspace | None = None,
    **options,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns carried on.

    The document at the cut comes with its first words only; ``n_chars``, if there is such a
    column, is the length of what is left. A document without words adds nothing to any
    budget and comes once per whole epoch. The documents are not shuffled: each is compared
    with the cut of its source where it is read.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    _, cuts = mix_plan(
        docs, doc_id, text, source, seed=seed, ties="text", workspace=workspace, **options
    )
    # Columns by place, so that no name of theirs can clash with one of ours.
    places = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    content, origin = F.col(places[text]), places[source]
    rows = docs.toDF(*places.values())
    rows = rows.withColumn("size", word_count(content))
    rows = rows.withColumn("key", mix_key(F.col(places[doc_id]), seed))
    lookup = cuts.select(F.col("source").alias(origin), *_CUT)
    rows = attach(
        rows, lookup, [origin], _CUT, null_safe=True, broadcast_bytes=BROADCAST_BYTES
    )
    partial = _partial_words(F.col("key"), F.col("size"), F.xxhash64(content))
    rows = rows.withColumn("partial", partial)
    # 0 stands for the partial copy, 1.. for the whole ones.
    none = F.array().cast("array<int>")
    epochs = F.col("epochs").cast("int")
    whole = F.when(epochs > 0, F.sequence(F.lit(1), epochs)).otherwise(none)
    last = F.when(F.col("partial") > 0, F.array(F.lit(0))).otherwise(none)
    rows = rows.withColumn("copy", F.explode(F.concat(whole, last)))
    short = (F.col("copy") == 0) & (F.col("partial") < F.col("size"))
    cut_text = first_words(content, F.col("partial"))
    changed = {text: cut_text}
    if n_chars in places:
        changed[n_chars] = F.length(cut_text).cast(docs.schema[n_chars].dataType)
    out = []
    for c, place in places.items():
        value = F.col(place)
        if c in changed:
            value = F.when(short, changed[c]).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out)
