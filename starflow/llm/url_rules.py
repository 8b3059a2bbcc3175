"""URL filters: fixed host and path rules, and association rules mined from labels.

The fixed rules label the pages they fit. On those labels Spark's FP-growth mines which
combinations of URL tokens (host names, path segments, parameter names) go along with a block;
rules with enough support and confidence are kept. A page that no fixed rule fits is blocked if it has
all tokens of a mined rule. Rules are matched by inverted index: a page's tokens are
joined with the rules' tokens, and a rule matches where as many tokens met as it has.

Defined results: a NULL url, or one without "://", has empty host and path and is allowed unless a
rule fits; repeated rows get equal results. Without labels nothing is mined. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import BROADCAST_BYTES, pick
from starflow.operators.lookup import attach
from starflow.sources.workspace import Workspace

ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT = 0.002  # of the labelled pages
MIN_CONFIDENCE = 0.9
_BLOCKED = "label=block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """From behind the first "://" up to /, ?, # or the end, A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From behind the host up to ?, # or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """(text, verdict) of the longest rule that fits, or NULL. Of equally long ones the first."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the longest is asked first
        fits = (host == rule.host) | host.endswith("." + rule.host)
        fits = fits & path.startswith(rule.path)
        made = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, made).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: names in the host with their depth, path segments, parameter names."""
    names = F.filter(F.split(host, r"\."), lambda x: x != "")
    levels = F.transform(F.reverse(names), lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x))
    # Numbers would be tokens of single pages: written by their first digit and length.
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    segments = F.transform(
        segments,
        lambda x: F.when(
            x.rlike(r"^[0-9]+"),
            F.concat(F.lit("path:"), F.substring(x, 1, 1), F.lit("#"), F.length(x).cast("string")),
        ).otherwise(F.concat(F.lit("path:"), x)),
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    parameters = F.filter(F.split(query, "&"), lambda x: x != "")
    parameters = F.transform(parameters, lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(levels, segments, parameters))


def mine_rules(
    labelled: DataFrame,
    *,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    workspace: Workspace,
) -> DataFrame:
    """(rule, tokens, support, confidence) from rows of (tokens, blocked).

    Support and confidence prune; so does a shorter rule that says the same: a rule goes if
    one with a token less is at least as confident.
    """
    schema = "rule bigint, tokens array<string>, support double, confidence double"
    blocked = F.when(F.col("blocked"), F.array(F.lit(_BLOCKED))).otherwise(F.array().cast("array<string>"))
    items = labelled.select(F.concat("tokens", blocked).alias("items"))
    if items.where(F.array_contains("items", _BLOCKED)).limit(1).count() == 0:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(_BLOCKED)))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "support", "confidence")
    rules = workspace.store(rules, "mined")
    shorter = F.transform(F.col("tokens"), lambda x: F.array_remove(F.col("tokens"), x))
    parts = rules.select("tokens", "confidence", F.explode(shorter).alias("part"))
    known = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    implied = parts.join(known, "part").where("part_confidence >= confidence").select("tokens")
    kept = rules.join(implied.distinct(), "tokens", "left_anti")
    kept = kept.withColumn("rule", F.xxhash64("tokens"))
    return workspace.store(kept.select("rule", "tokens", "support", "confidence"), "rules")


def match_rules(pages: DataFrame, rules: DataFrame, workspace: Workspace) -> DataFrame:
    """(row, rule) of every row of (row, tokens) that has all tokens of a rule.

    The index leads from each token to the rules that have it as their rarest token; the
    other tokens are then looked for in the page's own list.
    """
    if rules.limit(1).count() == 0:
        return pages.sparkSession.createDataFrame([], f"row bigint, rule bigint")
    carried = pages.select("row", "tokens", F.explode("tokens").alias("token"))
    counts = workspace.store(carried.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token_counts")
    heads = rules.select("rule", "tokens", F.explode("tokens").alias("token")).join(counts, "token", "left")
    heads = heads.groupBy("rule").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"),
        F.first("tokens").alias("needs"),
    )
    index = heads.groupBy("token").agg(F.collect_list(F.struct("rule", "needs")).alias("rules"))
    index = workspace.store(index, "index")
    size = index.agg(F.coalesce(F.sum(F.length(F.to_json("rules")) + 64), F.lit(0))).first()[0]
    hit = attach(carried, index, ["token"], ["rules"], size=size, broadcast_bytes=BROADCAST_BYTES)
    met = hit.where(F.col("rules").isNotNull()).select("row", "tokens", F.explode("rules").alias("r"))
    full = met.where(F.size(F.array_except("r.needs", "tokens")) == 0)
    return full.select("row", F.col("r.rule").alias("rule")).distinct()


def judge_urls(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    *,
    rules: Sequence[Rule] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the mined rule that decided."""
    workspace = workspace or Workspace(pages.sparkSession)
    rows = pick(pages, id=page_id, url=url)
    rows = rows.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    rows = rows.withColumn("fixed", matching_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("tokens", url_tokens(F.col("host"), F.col("path"), F.col("url"))).drop("url")
    rows = workspace.store(rows, "urls", row_id="row")
    labelled = rows.where(F.col("fixed").isNotNull()).select(
        "tokens", (F.col("fixed.verdict") == BLOCK).alias("blocked")
    )
    mined = mine_rules(labelled, min_support=min_support, min_confidence=min_confidence, workspace=workspace)
    open_rows = rows.where(F.col("fixed").isNull())
    matched = match_rules(open_rows.select("row", "tokens"), mined, workspace)
    matched = matched.join(mined.select("rule", "confidence", "support", "tokens"), "rule")
    best = matched.groupBy("row").agg(
        F.max(F.struct("confidence", "support", "tokens"))["tokens"].alias("mined")
    )
    verdict = F.coalesce("fixed.verdict", F.when(F.col("mined").isNotNull(), BLOCK).otherwise(ALLOW))
    return rows.join(best, "row", "left").select(
        F.col("id").alias(page_id), "host", "path", F.col("fixed.text").alias("rule"),
        verdict.alias("verdict"), F.concat_ws(" ", "mined").alias("mined_rule"),
    )
