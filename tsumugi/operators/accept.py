"""The first passing samples of each category and style, and their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(passing: DataFrame, needed: DataFrame, target: int, order: tuple[str, ...] = ("round", "batch_idx", "sample_idx")) -> DataFrame:
    """Of each category and style the first ``needed`` rows in ``order``.

    No style needs more than ``target``; that constant bound lets each task keep its first rows before the shuffle, however
    large a group is.
    """
    place = F.row_number().over(Window.partitionBy("category", "style").orderBy(*order))
    bounded = passing.withColumn("place", place).where(F.col("place") <= target)
    return bounded.join(needed.select("category", "style", "needed"), ["category", "style"]).where(F.col("place") <= F.col("needed")).drop("needed")


def category_mismatch(samples: DataFrame) -> DataFrame:
    """``category, n, differing``: samples (``category, model_category``) of each category asked for, and how many report another or none."""
    return samples.groupBy("category").agg(F.count("*").alias("n"), F.count_if(~F.col("model_category").eqNullSafe(F.col("category"))).alias("differing"))


def sample_id(run_id: str, *parts: str) -> Column:
    """An id that recomputation can't change, in the form of a UUID."""
    h = F.sha2(F.concat_ws("/", F.lit(run_id), *[F.col(p).cast("string") for p in parts]), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def stamped(accepted: DataFrame, model: str, run_id: str, created_at: Column | None = None) -> DataFrame:
    """Output rows: the sample with its provenance. ``created_at`` is the current time unless given."""
    return accepted.select(
        "title", "body", F.coalesce("model_category", "category").alias("category"), F.coalesce("model_style", "style").alias("style"),
        F.lit(True).alias("is_synth"), "seed_ids", F.col("style").alias("prompt_style"), F.lit(model).alias("gen_model"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
        sample_id(run_id, "category", "style", "round", "batch_idx", "sample_idx").alias("uuid"),
    )
