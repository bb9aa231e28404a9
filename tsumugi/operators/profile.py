"""Profile of a labelled corpus: counts, deficits, length statistics, distributions. Each is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: How a missing value is written, and so its length, in length statistics.
MISSING = "nan"


def with_lengths(corpus: DataFrame) -> DataFrame:
    """``title_len`` and ``body_len`` in code points; a null counts as ``MISSING``."""
    return corpus.withColumns({f"{c}_len": F.length(F.coalesce(c, F.lit(MISSING))) for c in ("title", "body")})


def valid_samples(corpus: DataFrame, least: int = 120) -> DataFrame:
    """Rows whose body has at least ``least`` characters; null bodies are out."""
    return corpus.where(F.length("body") >= least)


def category_counts(corpus: DataFrame) -> DataFrame:
    """``category, n``; rows without category aren't counted."""
    return corpus.where("category is not null").groupBy("category").agg(F.count("*").alias("n"))


def deficits(corpus: DataFrame, target: int = 100) -> DataFrame:
    """``category, needed`` of categories below ``target``; all their rows count, short ones too."""
    return category_counts(corpus).where(F.col("n") < target).select("category", (F.lit(target) - F.col("n")).alias("needed"))


def top_deficits(corpus: DataFrame, target: int = 100, k: int = 10) -> DataFrame:
    return deficits(corpus, target).orderBy(F.desc("needed"), "category").limit(k)


def totals(corpus: DataFrame, target: int = 100, least: int = 120) -> DataFrame:
    """One row: rows, valid and filtered rows, categories, rows needed."""
    by_category = corpus.groupBy("category").agg(F.count("*").alias("n"), F.count_if(F.length("body") >= least).alias("valid"))
    named = F.col("category").isNotNull()
    return by_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("valid")), F.lit(0)).alias("filtered_rows"),
        F.count_if(named).alias("categories"),
        F.coalesce(F.sum(F.when(named & (F.col("n") < target), target - F.col("n"))), F.lit(0)).alias("total_needed"),
    )


def length_stats(corpus: DataFrame) -> DataFrame:
    """``field`` and count, mean, sample deviation, minimum, exact quartiles (interpolated), maximum of title and body lengths.

    Lengths are counted first, so that the quartiles come from a histogram whose size is the number of different lengths.
    """
    lengths = with_lengths(corpus).select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{c}_len").alias("x")) for c in ("title", "body")])).alias("s"))
    counts = lengths.groupBy("s.field", "s.x").agg(F.count("*").alias("w"))
    w, x = F.col("w"), F.col("x").cast("double")
    mean = F.sum(x * w) / F.sum(w)
    # squares of whole numbers, exact in doubles up to 2**53
    variance = (F.sum(x * x * w) - F.sum(x * w) * F.sum(x * w) / F.sum(w)) / F.when(F.sum(w) > 1, F.sum(w) - 1)
    quartiles = [F.percentile("x", F.lit(q), w).alias(n) for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    return counts.groupBy("field").agg(F.sum("w").alias("n"), mean.alias("mean"), F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std"), F.min("x").alias("min"), *quartiles, F.max("x").alias("max"))


def style_distribution(samples: DataFrame, column: str = "prompt_style") -> DataFrame:
    """``style, n, percent`` of all rows that have one."""
    counts = samples.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("style")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def categories_in_order(corpus: DataFrame) -> DataFrame:
    """``category, first_row``: categories by first appearance."""
    return corpus.where("category is not null").groupBy("category").agg(F.min("row_id").alias("first_row"))
