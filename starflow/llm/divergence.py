"""How far each source's vocabulary stands from the other sources of its language.

Inside ``mapInArrow`` the texts go through Arrow's compute functions alone: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and a hash ``group_by`` give partial counts, which each
task merges before they leave it. The counts are summed by (language, source, term), the terms in
too few documents go, and shards that hold whole terms, columns side by side, compute the
divergences.

Shares are whole numbers: p = 1 + floor(UNIT * (count + 1) / (N + V)), and the distance of p from q is
floor((p - q)^2 / q). All sums are exact. Of two sources only the terms that both have must meet;
what a term of one source adds against an absent one depends on its count alone, and is
taken from the histogram of counts:

    sum over all terms = V f(0,0) + sum over A of f(a,0)-f(0,0) + sum over B of f(0,b)-f(0,0)
                         + sum over both of f(a,b)-f(a,0)-f(0,b)+f(0,0)

At scale: a shard streams its terms in order, so a task holds some CHUNK rows or the sources of one
term. The pairs of sources are the result itself (one row each); the join that makes them is
dealt over GRID fragments per language, so one language may hold everything. The top terms are cut
in every shard before they are ranked.

Defined results: NULL text, language and source count as ''. A source without terms, or whose terms
are all rare, has count 0 everywhere and still gets its rows. A language without kept terms has
distance 0 everywhere. Rows are documents: a repeated row is one more document. A language of one
source has no ``pair`` rows. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.rows import BROADCAST_BYTES, pick, slices
from starflow.operators.lookup import attach
from starflow.sources.workspace import Workspace

# Fixed values of the audit.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = 1_000_000_000
LEAST_DOCS = 3
TOP = 200

CHUNK = 200_000  # rows that a shard works on at once
GRID = 32  # fragments of a language in the join of its sources
_HELD = 600_000  # partial counts that a task merges before they leave it
_PAIRS = 1_000_000  # meetings of two sources worked on at once
_COUNTS = ["lang", "source", "term", "n", "docs"]


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of one batch of (lang, source, text)."""
    lang, source = (pc.dictionary_encode(batch.column(k)) for k in (0, 1))
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), pattern=SEPARATORS)
    terms = pc.dictionary_encode(pc.list_flatten(parts))
    table = pa.table({"row": pc.list_parent_indices(parts), "term": terms.indices})
    table = table.filter(pc.not_equal(pc.take(pc.binary_length(terms.dictionary), table["term"]), 0))
    per_doc = table.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    code = pc.add(
        pc.multiply(pc.cast(lang.indices, pa.int64()), len(source.dictionary)), pc.cast(source.indices, pa.int64())
    )
    per_doc = pa.table(
        {"group": pc.take(code, per_doc["row"]), "term": per_doc["term"], "n": per_doc["count_all"]}
    )
    summed = per_doc.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    group = summed["group"].to_numpy()
    width = max(1, len(source.dictionary))
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(group // width)),
            "source": source.dictionary.take(pa.array(group % width)),
            "term": terms.dictionary.take(summed["term"].combine_chunks()),
            "n": pc.cast(summed["n_sum"], pa.int64()),
            "docs": pc.cast(summed["count_all"], pa.int64()),
        }
    )


def merge_counts(tables: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(tables).group_by(_COUNTS[:3], use_threads=False)
    merged = merged.aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([merged[c] for c in (*_COUNTS[:3], "n_sum", "docs_sum")], names=_COUNTS)


def term_counts(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of all rows of (lang, source, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in slices(batches):
            held.append(count_terms(batch))
            if sum(t.num_rows for t in held) > _HELD:
                held = [merge_counts(held)]
                if held[0].num_rows > _HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=50_000)
        if held:
            yield from merge_counts(held).to_batches(max_chunksize=50_000)

    schema = "lang string, source string, term string, n bigint, docs bigint"
    parts = rows.mapInArrow(run, schema)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / whole) by long division, three digits at a time.

    Exact while ``whole`` is below 2^63 / 1000.
    """
    if len(whole) and whole.max() > (1 << 63) // 1000:
        raise OverflowError("more than 9.2e15 terms in one source")
    rest, out = count + 1, np.zeros(len(count), dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest %= whole
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _sum_by(code: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, value = code[order], value[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, dtype=np.int64)
    return code[first], np.add.reduceat(value, first) if len(first) else value


def meetings(term: np.ndarray, group: np.ndarray, groups: int, p: np.ndarray, none: np.ndarray):
    """(group * groups + other, sum) over the terms that both groups have, in order of terms.

    Every entry meets all entries of its term, block by block.
    """
    start = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    size = np.diff(np.append(start, len(term)))
    of = np.repeat(np.arange(len(start)), size)
    ends = np.cumsum(size[of])
    codes, sums, at = [], [], 0
    while at < len(term):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + _PAIRS, side="right")))
        width = size[of[at:stop]]
        a = np.repeat(np.arange(at, stop), width)
        b = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + start[of[a]]
        a, b = a[a != b], b[a != b]
        value = distance(p[a], p[b]) - distance(p[a], none[b]) - distance(none[a], p[b]) + distance(none[a], none[b])
        code, value = _sum_by(group[a] * groups + group[b], value)
        codes.append(code)
        sums.append(value)
        at = stop
    return _sum_by(np.concatenate(codes), np.concatenate(sums))


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)


def _new_term(table: pa.Table) -> np.ndarray:
    """Where another term starts, the first row included."""
    return np.append(True, _changes(table["term"]) | _changes(table["lang"]))


def shard_rows(table: pa.Table, top: int) -> pa.RecordBatch:
    """(lang, source, part, item, value): what whole terms add to the pairs, and their top terms."""
    term = np.cumsum(_new_term(table))
    number = [pc.dictionary_encode(table[c].combine_chunks()) for c in ("lang", "source")]
    width = len(number[1].dictionary)
    group, code = np.unique(
        number[0].indices.to_numpy().astype(np.int64) * width + number[1].indices.to_numpy(), return_inverse=True
    )
    n, whole, lang_n, lang_whole = (table[c].to_numpy() for c in ("n", "whole", "lang_n", "lang_whole"))
    p, none, q = share(n, whole), share(np.zeros_like(n), whole), share(lang_n, lang_whole)
    pair, value = meetings(term, code, len(group), p, none)
    a, b = group[pair // len(group)], group[pair % len(group)]

    above = np.flatnonzero(p > q)
    far = distance(p[above], q[above])
    order = np.lexsort((above, -far, code[above]))  # rows come in the order of terms
    of = code[above][order]
    first = np.append(True, of[1:] != of[:-1]) if len(of) else np.zeros(0, dtype=bool)
    place = np.arange(len(of)) - np.maximum.accumulate(np.where(first, np.arange(len(of)), 0)) if len(of) else of
    order = order[place < top]
    at = above[order]
    text = pa.string()
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([number[0].dictionary.take(pa.array(a // width)).cast(text), table["lang"].combine_chunks().take(pa.array(at)).cast(text)]),
            pa.concat_arrays([number[1].dictionary.take(pa.array(a % width)).cast(text), table["source"].combine_chunks().take(pa.array(at)).cast(text)]),
            pa.array(["pair"] * len(a) + ["term"] * len(at), text),
            pa.concat_arrays([number[1].dictionary.take(pa.array(b % width)).cast(text), table["term"].combine_chunks().take(pa.array(at)).cast(text)]),
            pa.array(np.concatenate([value, far[order]])),
        ],
        ["lang", "source", "part", "item", "value"],
    )


def shard_divergences(kept: DataFrame, top: int) -> DataFrame:
    """What the shards find in (lang, source, term, n, whole, lang_n, lang_whole)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < CHUNK:
                continue
            table = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(_new_term(table))[-1])  # the last term may go on
            if cut:
                yield shard_rows(table.slice(0, cut), top)
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield shard_rows(pa.Table.from_batches(held), top)

    whole = kept.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return whole.mapInArrow(run, "lang string, source string, part string, item string, value bigint")


def _share(count: Column, whole: Column) -> Column:
    exact = (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", exact, F.nullif(whole, F.lit(0)).cast("decimal(20,0)")) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(kept: DataFrame, groups: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language."""
    nothing = _share(F.lit(0), F.col("whole"))
    counts = kept.groupBy("lang", "source", "whole", "n").agg(F.count(F.lit(1)).alias("times"))
    counts = counts.select(
        "lang", "source", _share(F.col("n"), F.col("whole")).alias("p"), nothing.alias("none"), "times", F.lit(False).alias("every")
    )
    every = groups.select("lang", "source", nothing.alias("p"), nothing.alias("none"), F.col("v").alias("times"), F.lit(True).alias("every"))
    left = counts.unionByName(every).withColumn("cell", F.pmod(F.xxhash64("source", "p"), F.lit(GRID)).cast("int"))
    right = groups.select(
        "lang", F.col("source").alias("item"), nothing.alias("other"),
        F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("cell"),
    )
    p, none, other = (F.col(c) for c in ("p", "none", "other"))
    times = F.col("times").cast("decimal(18,0)")

    def counted(value: Column) -> Column:
        return F.sum(times * value.cast("decimal(20,0)")).cast("decimal(38,0)")

    met = left.join(right, ["lang", "cell"]).where("source <> item").groupBy("lang", "source", "item").agg(
        counted(F.when(F.col("every"), _distance(none, other)).otherwise(_distance(p, other) - _distance(none, other))).alias("there"),
        counted(F.when(F.col("every"), F.lit(0)).otherwise(_distance(other, p) - _distance(other, none))).alias("back"),
    )
    parts = met.select("lang", "source", "item", F.col("there").alias("value"))
    parts = parts.union(met.select("lang", F.col("item"), F.col("source"), F.col("back")))
    parts = parts.union(
        shards.where("part = 'pair'").select("lang", "source", "item", F.col("value").cast("decimal(38,0)"))
    )
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return summed.withColumn("value", F.coalesce("value", F.lit(0)).cast("bigint"))


def source_divergences(
    docs: DataFrame,
    *,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms
    that a source has more of than its language."""
    workspace = workspace or Workspace(docs.sparkSession)
    rows = pick(docs, lang=lang, source=source, text=text)
    rows = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = workspace.store(term_counts(rows), "term_counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counted.select(
        "lang", "source", "term", "n",
        F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("lang_docs"),
        (F.row_number().over(of_term.orderBy("source")) == 1).alias("first"),
    )
    kept = workspace.store(kept.where(F.col("lang_docs") >= least_docs).drop("lang_docs"), "kept_terms")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if("first").alias("v"))
    found = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    of_lang = found.groupBy("lang").agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("lang_n")
    )
    of_lang = workspace.store(of_lang, "langs")
    groups = attach(
        found.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), of_lang, ["lang"], ["v", "lang_n"],
        broadcast_bytes=BROADCAST_BYTES,
    )
    groups = groups.select(
        "lang", "source", "v", (F.col("n") + F.col("v")).alias("whole"), (F.col("lang_n") + F.col("v")).alias("lang_whole")
    )
    groups = workspace.store(groups, "groups")
    kept = attach(
        kept.drop("first"), groups, ["lang", "source"], ["whole", "lang_whole"],
        broadcast_bytes=BROADCAST_BYTES, spread_by=["term"],
    )
    columns = ["lang", "source", "term", "n", "whole", "lang_n", "lang_whole"]
    shards = workspace.store(shard_divergences(kept.select(*columns), top), "shards")

    order = [F.col("value").desc(), F.col("item")]
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)).alias("rank")
    pairs = _pair_sums(kept, groups, shards).select("lang", "source", F.lit("pair").alias("part"), "item", "value", place)
    terms = shards.where("part = 'term'").select("lang", "source", "part", "item", "value", place)
    return pairs.unionByName(terms.where(F.col("rank") <= top))
