"""Quality rules over candidates, as expressions, and the validation that combines them with similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsumugi.config import SAFETY_PATTERNS, Config
from tsumugi.functions.text import mean_length, python_regex, sentences, share
from tsumugi.operators.similarity import cosine_measure, largest, overlap_measure
from tsumugi.sources.files import staged

#: Order of the reasons.
REASONS = ("malformed", "length", "cosine", "ngram", "language", "title_safety", "body_safety")


def length_problem(title: Column, body: Column, title_min: Column, title_max: Column, body_min: Column, body_max: Column, default: tuple[int, int] = (120, 600)) -> Column:
    """``title`` or ``body``, whichever is first out of its inclusive bounds; null if none. A null title range isn't tested."""
    low, high = F.coalesce(body_min, F.lit(default[0])), F.coalesce(body_max, F.lit(default[1]))
    bad_title = title_min.isNotNull() & title_max.isNotNull() & ~F.length(title).between(title_min, title_max)
    return F.when(bad_title, "title").when(~F.length(body).between(low, high), "body")


def in_range(text: Column, low: int, high: int) -> Column:
    return F.length(text).between(low, high)


def language_problem(text: Column, config: Config = Config()) -> Column:
    """``script``, ``terminator`` or ``sentences``, whichever is first; null if none. An empty text has no script to test."""
    mean = mean_length(sentences(text))
    ends = [F.contains(text, F.lit(t)) for t in config.terminators]
    any_end = ends[0]
    for e in ends[1:]:
        any_end = any_end | e
    low, high = config.sentence_range
    return F.when(F.coalesce(share(text, *config.script_range) < config.script_share, F.lit(False)), "script").when(~any_end, "terminator").when(F.coalesce(~mean.between(low, high), F.lit(False)), "sentences")


def safety_problem(text: Column, patterns: tuple[tuple[str, str], ...] = SAFETY_PATTERNS) -> Column:
    """Name of the first pattern that occurs; null if none."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(patterns):
        out = F.when(text.rlike(python_regex(pattern)), name).otherwise(out)
    return out


def with_ranges(rows: DataFrame, styles: DataFrame, config: Config = Config()) -> DataFrame:
    """``rows`` with the length ranges of their ``style``; a style without a preset has the default ones. A preset's null title range stays."""
    ranges = styles.select(F.col("name").alias("style"), "title_min", "title_max", "body_min", "body_max", F.lit(True).alias("_preset"))
    known, title = F.coalesce("_preset", F.lit(False)), dict(zip(("title_min", "title_max"), config.title_range))
    return rows.join(ranges, "style", "left").withColumns({c: F.when(known, F.col(c)).otherwise(F.lit(d)) for c, d in title.items()}).drop("_preset")


def validate(candidates: DataFrame, references: DataFrame, styles: DataFrame, config: Config = Config()) -> DataFrame:
    """``candidates`` with ``passed``, ``reasons`` (in the order of ``REASONS``) and ``metrics``.

    ``candidates``: ``id, category, style, title, body`` and ``model_category``, which decides whether similarity is skipped.
    ``references``: ``id, category, text``. ``styles``: the presets. All rules are applied; a candidate with a null title or body is
    ``malformed`` and has no other reason. A style without a preset has the default ranges. Rules aside from similarity are one
    projection; similarity is skipped, with metric 0, for the categories of the skip list.
    """
    skipped = F.coalesce(F.col("model_category").isin(*config.skipped), F.lit(False))
    malformed = F.col("title").isNull() | F.col("body").isNull()
    measured, _ = staged(candidates.where(~malformed & ~skipped).select("id", "category", F.col("body").alias("text")), "candidates")
    metrics = largest(measured, references, cosine_measure(config.tfidf_grams), overlap_measure(config.overlap_gram))
    full = with_ranges(candidates, styles, config).join(metrics, "id", "left").withColumns({"cosine": F.coalesce("cosine", F.lit(0.0)), "overlap": F.coalesce("overlap", F.lit(0.0))})
    tests = {
        "malformed": malformed,
        "length": length_problem(F.col("title"), F.col("body"), F.col("title_min"), F.col("title_max"), F.col("body_min"), F.col("body_max"), config.body_range).isNotNull(),
        "cosine": ~skipped & (F.col("cosine") >= config.cosine_limit),
        "ngram": ~skipped & (F.col("overlap") >= config.overlap_limit),
        "language": language_problem(F.col("body"), config).isNotNull(),
        "title_safety": safety_problem(F.col("title")).isNotNull(),
        "body_safety": safety_problem(F.col("body")).isNotNull(),
    }
    reasons = F.filter(F.array(*[F.when(tests[r] & (F.lit(True) if r == "malformed" else ~malformed), r) for r in REASONS]), lambda r: r.isNotNull())
    done = full.withColumn("reasons", reasons).withColumn("metrics", F.create_map(F.lit("max_cosine"), F.col("cosine"), F.lit("max_overlap"), F.col("overlap")))
    return done.withColumn("passed", F.size("reasons") == 0).select(*[candidates[c] for c in candidates.columns], "passed", "reasons", "metrics")


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected candidates; a validation used for both should be written or persisted before."""
    return validated.where("passed"), validated.where("not passed")


def reason_counts(validated: DataFrame) -> DataFrame:
    return validated.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
