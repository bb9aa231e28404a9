"""The pN_ queries, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsumugi.llm import near, sampling
from tsumugi.llm.common import stage, table, trimmed
from tsumugi.llm.history import repeats
from tsumugi.llm.leaks import leaks
from tsumugi.llm.pii import redact
from tsumugi.llm.spans import shared_spans
from tsumugi.llm.subset import varied_subsets
from tsumugi.llm.text import same_looking_pairs, settle, unify
from tsumugi.llm.tokenize import encode_corpus


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category tree of the requests: category under its style under that style's tone; style under its tone.

    A category's style is the first one allowed, or else the preset most of its generated samples were asked for.
    """
    preset = table(spark, sf_dir, "style_preset").select("name", "tone")
    allowed = table(spark, sf_dir, "allowed_style").groupBy("category").agg(F.min_by("style", "pos").alias("allowed"))
    asked = table(spark, sf_dir, "augmented_data").select(trimmed(F.col("category")).alias("category"), F.col("prompt_style").alias("name")).where("category <> ''").groupBy("category", "name").agg(F.count("*").alias("n"))
    usual = asked.join(preset, "name", "left_semi").groupBy("category").agg(F.min(F.struct((-F.col("n")).alias("n"), "name")).alias("x")).select("category", F.col("x.name").alias("usual"))
    first = usual.join(allowed, "category", "full").select("category", F.coalesce("allowed", "usual").alias("name"))
    return first.join(preset, "name", "left").select(F.col("category").alias("stratum"), F.col("name").alias("parent"), F.col("tone").alias("grandparent")).unionByName(preset.select(F.col("name").alias("stratum"), F.col("tone").alias("parent"), F.lit("style").alias("grandparent")))


def _p1(spark: SparkSession, sf_dir: str) -> tuple[dict, DataFrame, DataFrame]:
    sources = {("merged_person_categories", "category"): (table(spark, sf_dir, "merged_person_categories"), "row_id"), ("augmented_data", "prompt_style"): (table(spark, sf_dir, "augmented_data"), "aug_id")}
    requests = table(spark, sf_dir, "sample_requests")
    report = sampling.sampling_report(sampling.available(sources, requests), requests, table(spark, sf_dir, "sample_targets"), _tree(spark, sf_dir))
    return sources, requests, report


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p1(spark, sf_dir)[2]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_report(spark, sf_dir).where("unmet > 0").select("request_id", "stratum")


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources, requests, report = _p1(spark, sf_dir)
    return sampling.draw(sampling.requested(sources, requests), stage(report, "p1_report"))


def p2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load 0 is the first history; each later load is a delivery that is checked against what is there by then."""
    return repeats(table(spark, sf_dir, "augmented_data"), "aug_id", "load_no", "category", "body")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_repeats(spark, sf_dir).select(F.col("id").alias("aug_id"))


P3_TABLES = {"augmented_data": "aug_id", "merged_person_categories": "row_id"}


def _p3(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [redact(table(spark, sf_dir, name), key, "body").select(F.lit(name).alias("table_name"), "*") for name, key in P3_TABLES.items()]
    return parts[0].unionByName(parts[1])


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir).select("table_name", "id", F.col("text").alias("body"), "spans")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir).select("table_name", "id", F.explode("kinds").alias("kind")).distinct()


def p4_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(unify(table(spark, sf_dir, "merged_person_categories"), "row_id", ["title", "body"])).select(F.col("id").alias("row_id"), "field", "stored", "unified")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_pairs(spark, sf_dir).drop("by")


def p4_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs, and whether the repair made them equal or, where the corpus has no form of a token, their shape."""
    return same_looking_pairs(unify(table(spark, sf_dir, "merged_person_categories"), "row_id", ["title", "body"]))


def p5_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = varied_subsets(table(spark, sf_dir, "merged_person_categories"), "row_id", "body", "category", table(spark, sf_dir, "subset_requests"))
    return found.withColumnRenamed("id", "row_id")


#: The tables of problem 6, in the order of their names, which gives the last bit of an id in both.
P6_TABLES = {"augmented_data": "aug_id", "merged_person_categories": "row_id"}


def _p6(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = [table(spark, sf_dir, name).select((F.col(key) * 2 + k).alias("id"), F.col("body").alias("text")) for k, (name, key) in enumerate(P6_TABLES.items())]
    return near.near_duplicates(parts[0].unionByName(parts[1]))


def _p6_named(prefix: str, of: str) -> list:
    names = F.array(*[F.lit(n) for n in P6_TABLES])
    bit = F.pmod(F.col(of), F.lit(2))
    return [F.element_at(names, (bit + 1).cast("int")).alias(f"table{prefix}"), ((F.col(of) - bit) / 2).cast("long").alias(f"id{prefix}")]


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with a body of enough characters, its class of copies, and its group."""
    members, pairs = _p6(spark, sf_dir)
    return near.components(members, pairs).select(*_p6_named("", "id"), F.col("rep").alias("class_id"), "group_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, pairs = _p6(spark, sf_dir)
    rank = lambda c: F.struct(F.pmod(F.col(c), F.lit(2)), F.col(c))
    both = near.expanded(members, pairs).withColumn("x", F.when(rank("a") < rank("b"), F.col("a")).otherwise(F.col("b"))).withColumn("y", F.when(rank("a") < rank("b"), F.col("b")).otherwise(F.col("a")))
    return both.select(*_p6_named("_a", "x"), *_p6_named("_b", "y"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text").withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_report(spark, sf_dir).where("verbatim").select("doc_id", "item_id")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_report(spark, sf_dir).where("shared_chars > 0").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}
