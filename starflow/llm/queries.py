"""The contract queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import (
    class_lm,
    divergence,
    exact_dedup,
    mixing,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    token_files,
    toxicity,
    url_rules,
    variants,
)
from starflow.llm.labelled import fold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_class_lm(spark, sf_dir):
    return class_lm.score_documents(_table(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, _table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs, model)


@query
def op4_secret_scan(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.train_secrets(docs))
    return found.select("doc_id", *secret_digests(F.col("spans")))


def secret_digests(spans: Column) -> list[Column]:
    return span_digests(spans, ("assign", "access", "hex"))


def span_digests(spans: Column, kinds: tuple[str, ...]) -> list[Column]:
    """The contract's columns from an array of (kind, start, end); ``kinds`` are the base ones."""

    def of_kind(kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    def written(some: Column) -> Column:
        parts = ("kind", "start", "end")
        return F.array_join(
            F.transform(some, lambda s: F.concat_ws(":", *[s[p].cast("string") for p in parts])), ","
        )

    base = F.filter(spans, lambda s: s["kind"] != "model")
    return [
        *[F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k in kinds],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    ]


@query
def op5_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_url_rules(spark, sf_dir):
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"))


@query
def op7_token_files(spark, sf_dir):
    return token_files.token_file_report(_table(spark, sf_dir, "documents"))


@query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


@query
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == toxicity.HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op11_spelling_variants(spark, sf_dir):
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.source_divergences(_table(spark, sf_dir, "documents"))


@query
def op13_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.train_pii(pii.labelled_passages(docs)))
    return found.select("doc_id", *span_digests(F.col("spans"), pii.KINDS[:-1]))
