"""Queries over the test tables, one for each operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsumugi.config import Config
from tsumugi.functions.text import mean_length, sentences, share
from tsumugi.operators import accept, allocate, parse, profile, prompts, quality, represent, similarity
from tsumugi.sources import files

#: Options of all queries: the limits of a full run, and the test tables' category that skips similarity.
CONFIG = Config(skip_categories=("債権買い取り",), cosine_limit=0.92, overlap_limit=0.35)
KEY = ["aug_id", "category", "style", "round", "batch_idx", "sample_idx"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "merged_person_categories")


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated samples as candidates, each key once; the requested style is ``prompt_style``."""
    df = table(spark, sf_dir, "augmented_data")
    return df.select("aug_id", "title", "body", "category", F.col("prompt_style").alias("style"), "round", "batch_idx", "sample_idx", F.col("category").alias("model_category")).distinct()


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.valid_samples(corpus(spark, sf_dir)).where("category is not null")
    return rows.select(F.col("row_id").alias("id"), "category", F.col("body").alias("text"))


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_counts(corpus(spark, sf_dir))


def needed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.deficits(corpus(spark, sf_dir), CONFIG.target)


def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.totals(corpus(spark, sf_dir), CONFIG.target, CONFIG.least_valid)


def top_deficits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_deficits(corpus(spark, sf_dir), CONFIG.target)


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_stats(corpus(spark, sf_dir)).select("field", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "p25", "p50", "p75", "max")


def valid_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.with_lengths(profile.valid_samples(corpus(spark, sf_dir), CONFIG.least_valid)).select("row_id", "category", "title_len", "body_len")


def category_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.categories_in_order(corpus(spark, sf_dir))


def style_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.style_distribution(table(spark, sf_dir, "augmented_data")).withColumn("percent", F.round("percent", 6))


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocate.style_matrix(needed_samples(spark, sf_dir), table(spark, sf_dir, "style_preset"), table(spark, sf_dir, "allowed_style"), CONFIG.most_styles, CONFIG.least_per_style)


def style_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir)


def style_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total needed by category, as the matrix has it."""
    return allocate.needed_by_category(_matrix(spark, sf_dir))


def processing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.in_processing_order(_matrix(spark, sf_dir)).select("category", "style", "position")


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocate.batches(_matrix(spark, sf_dir), CONFIG.per_request).select("category", "style", "batch_idx")


def style_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overall allotment of the total deficit over all styles."""
    limits = [(r["style"], r["share_limit"]) for r in allocate.few(table(spark, sf_dir, "style_limit"))]
    presets = [r["name"] for r in allocate.few(table(spark, sf_dir, "style_preset"))]
    t = corpus_totals(spark, sf_dir).first()
    made = allocate.style_allocation(limits, presets, t["total_needed"], t["categories"])
    return spark.createDataFrame(list(made.items()), "style string, samples bigint")


def k_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profile.category_counts(profile.valid_samples(corpus(spark, sf_dir)))
    return counts.select("category", "n", allocate.clusters(F.col("n")).alias("k"))


def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("row_id", *represent.feature_columns(F.col("body"))).distinct()


def nearest_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").alias("vector"))
    return represent.nearest_to_centroid(points, ["label"], "vec_id").select("label", "vec_id", F.round("distance", 6).alias("distance"))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return represent.features(profile.valid_samples(corpus(spark, sf_dir)).distinct())


def pairwise_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of the rows nearest to the centres of each category, by their seven counts: what the greedy filter sees."""
    return represent.pairwise(represent.central(_valid(spark, sf_dir), CONFIG.seed)).withColumn("similarity", F.round("similarity", 6))


def representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return represent.representatives(_valid(spark, sf_dir), CONFIG.mutual_similarity, CONFIG.seed)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "augmented_data").where("body is not null").select(F.col("aug_id").alias("id"), "category", F.col("body").alias("text"))


def ngram_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.overlaps(_measured(spark, sf_dir), references(spark, sf_dir)).select(F.col("id").alias("aug_id"), F.round("overlap", 6).alias("overlap"))


def ngram_overlap_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same against another reference set: the definition of each category."""
    defined = table(spark, sf_dir, "category_definition").where("definition is not null").select(F.xxhash64("category").alias("id"), "category", F.col("definition").alias("text"))
    return similarity.overlaps(_measured(spark, sf_dir), defined).select(F.col("id").alias("aug_id"), F.round("overlap", 6).alias("overlap"))


def tfidf_max_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.cosines(_measured(spark, sf_dir), references(spark, sf_dir)).select(F.col("id").alias("aug_id"), F.round("cosine", 6).alias("cosine"))


def length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generated(spark, sf_dir).where("title is not null and body is not null")
    full = quality.with_ranges(rows, table(spark, sf_dir, "style_preset"), CONFIG)
    problem = quality.length_problem(F.col("title"), F.col("body"), F.col("title_min"), F.col("title_max"), F.col("body_min"), F.col("body_max"))
    return full.select("aug_id", "style", F.coalesce(problem, F.lit("none")).alias("problem"))


def language_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).where("body is not null").select("aug_id", F.coalesce(quality.language_problem(F.col("body"), CONFIG), F.lit("none")).alias("problem"))


def script_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).where("body <> ''").select("aug_id", F.round(share(F.col("body"), *CONFIG.script_range), 6).alias("script_share"))


def sentence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = sentences(F.col("body"))
    return generated(spark, sf_dir).where("body is not null").select("aug_id", F.size(parts).alias("n"), F.round(F.coalesce(mean_length(parts), F.lit(0.0)), 6).alias("mean_len"))


def safety_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).where("body is not null").select("aug_id", F.coalesce(quality.safety_problem(F.col("body")), F.lit("none")).alias("problem"))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generated(spark, sf_dir).withColumn("id", F.col("aug_id"))
    return quality.validate(rows, references(spark, sf_dir), table(spark, sf_dir, "style_preset"), CONFIG)


def validate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, m = _validated(spark, sf_dir), lambda k: F.round(F.element_at("metrics", k), 6)
    return v.select("aug_id", "passed", F.array_join("reasons", ",").alias("reasons"), m("max_cosine").alias("max_cosine"), m("max_overlap").alias("max_overlap"))


def rejected_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split(_validated(spark, sf_dir))[1].select("aug_id", F.array_join("reasons", ",").alias("reasons"))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reason_counts(_validated(spark, sf_dir))


def accepted_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passing samples in the order they came in, until each category and style has what it needs."""
    first = accept.first_n(quality.split(_validated(spark, sf_dir))[0], _matrix(spark, sf_dir), CONFIG.target, ("round", "batch_idx", "sample_idx", "aug_id"))
    return first.select("aug_id", "category", "style", "place")


def category_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many samples of each category asked for report another one; asked for was the category of the sample's first seed."""
    rows = table(spark, sf_dir, "augmented_data").select("aug_id", F.col("category").alias("model_category"), F.get("seed_ids", F.lit(0)).cast("long").alias("row_id")).distinct()
    seeds = corpus(spark, sf_dir).where("category is not null").groupBy("row_id").agg(F.min("category").alias("category"))
    return accept.category_mismatch(rows.join(seeds, "row_id"))


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each category's representatives as its examples."""
    shown = represent.shown(profile.valid_samples(corpus(spark, sf_dir), CONFIG.least_valid), CONFIG.mutual_similarity, CONFIG.seed)
    return prompts.examples(shown, CONFIG.example_chars)


def fewshot_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prompts.with_examples(_matrix(spark, sf_dir), _examples(spark, sf_dir))
    return rows.select("category", "style", F.size("examples").alias("n_examples"), F.array_join("seed_ids", ",").alias("seeds"))


def style_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instruction of each style that samples name; retired ones have that of the first preset."""
    named = table(spark, sf_dir, "augmented_data").select(F.col("prompt_style").alias("style")).where("style is not null").distinct()
    return prompts.with_instruction(named, table(spark, sf_dir, "style_preset")).select("style", "instruction")


def definition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.with_definition(needed_samples(spark, sf_dir), table(spark, sf_dir, "category_definition")).select("category", "definition")


def prompt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = prompts.requests(_matrix(spark, sf_dir), table(spark, sf_dir, "category_definition"), table(spark, sf_dir, "style_preset"), _examples(spark, sf_dir), CONFIG)
    text = lambda i: F.concat_ws(": ", F.get("messages", F.lit(i))["role"], F.get("messages", F.lit(i))["content"])
    return made.select("category", "style", "batch_idx", text(0).alias("system"), text(1).alias("prompt"), F.array_join("shown_seed_ids", ",").alias("shown"))


def recorded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as a model would have given them, made of up to four generated samples each.

    By their number they are a bare list, one in a fence, in prose, a single object, a list with something after it, one whose
    first item is no object, or an object that holds the list.
    """
    rows = generated(spark, sf_dir).where("category is not null and style is not null")
    one = F.to_json(F.struct("title", "body", "category", "style"), {"ignoreNullFields": "false"})
    answer = F.floor(F.col("aug_id") / 4).cast("int")
    items = rows.select(answer.alias("batch_idx"), F.struct("aug_id", "category", "style", one.alias("json")).alias("s")).groupBy("batch_idx").agg(F.array_sort(F.collect_list("s")).alias("s"))  # four at most
    listed, form = F.concat(F.lit("["), F.array_join(F.col("s.json"), ", "), F.lit("]")), F.col("batch_idx") % 7
    first = F.get("s", F.lit(0))
    shapes = (listed, F.concat(F.lit("```json\n"), listed, F.lit("\n```")), F.concat(F.lit("Here it is: "), listed, F.lit(" Done.")), first["json"], F.concat(listed, F.lit(" tail")), F.concat(F.lit('["none", '), F.substring(listed, 2, 2**31 - 1)), F.concat(F.lit('{"samples": '), listed, F.lit("}")))
    content = F.lit(None).cast("string")
    for k, shape in enumerate(shapes):
        content = F.when(form == k, shape).otherwise(content)
    return items.select(first["category"].alias("category"), first["style"].alias("style"), F.lit(0).alias("round"), "batch_idx", content.alias("content"))


def parse_llm_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.candidates(recorded_answers(spark, sf_dir)).select("batch_idx", "sample_idx", "title", "body", "malformed")


def pending_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without an answer among the samples: what a stopped run still has to ask."""
    asked = allocate.batches(_matrix(spark, sf_dir), CONFIG.per_request).withColumn("round", F.lit(0))
    done = table(spark, sf_dir, "augmented_data").select("category", F.col("prompt_style").alias("style"), "round", "batch_idx")
    return files.pending(asked, done).select("category", "style", "batch_idx")


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output rows of the samples with a title and a body, with ids that recomputation can't change."""
    rows = table(spark, sf_dir, "augmented_data").where("title is not null and body is not null and category is not null and prompt_style is not null")
    full = rows.select("aug_id", "title", "body", "category", F.col("prompt_style").alias("style"), F.col("style").alias("model_style"), F.col("category").alias("model_category"), "round", "batch_idx", F.col("aug_id").alias("sample_idx"), "seed_ids").distinct()
    made = accept.stamped(full, "replay", "run", F.timestamp_seconds(F.lit(86_400)))
    return made.select("uuid", "title", "body", "category", "style", "is_synth", F.array_join("seed_ids", ",").alias("seeds"), "prompt_style", "gen_model", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    chosen = (
        category_counts, needed_samples, corpus_totals, top_deficits, length_stats, valid_samples, category_order, style_distribution, style_matrix, style_needs, processing_order,
        batch_plan, style_allocation, k_by_category, text_features, nearest_to_centroid, pairwise_cosine, representatives, ngram_overlap, ngram_overlap_definitions, tfidf_max_cosine,
        length_check, language_quality, script_share, sentence_stats, safety_scan, validate_all, rejected_samples, reject_reasons, accepted_first_n, category_mismatch, fewshot_join,
        style_prompts, definition_join, prompt_messages, parse_llm_json, pending_requests, provenance,
    )
    return {f.__name__: f for f in chosen}
