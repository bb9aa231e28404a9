"""Allocation of deficits over styles and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Styles are a list in the plan; more are an error.
MOST_STYLES = 1000


def few(rows: DataFrame) -> list:
    """All rows of a small table of styles, by ``pos``."""
    found = rows.orderBy("pos").limit(MOST_STYLES + 1).collect()
    if len(found) > MOST_STYLES:
        raise ValueError(f"more than {MOST_STYLES} styles")
    return found


def style_matrix(needs: DataFrame, styles: DataFrame, allowed: DataFrame | None = None, most: int = 5, least: int = 5) -> DataFrame:
    """``category, style, style_pos, needed``: each category's deficit over its first allowed styles.

    The number of styles is the deficit over ``least``, at most ``most`` and the styles allowed, at least one; each gets the same,
    the first ones one more for the remainder. A category without rows in ``allowed`` allows all styles. Nothing for no deficit.
    """
    listed = few(styles.select("pos", "name"))
    every = F.array(*[F.struct(F.lit(r["pos"]).cast("int").alias("pos"), F.lit(r["name"]).alias("style")) for r in listed]).cast("array<struct<pos:int,style:string>>")
    options = needs.where("needed > 0")
    if allowed is None:
        options = options.withColumn("list", every)
    else:
        own = allowed.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("pos", "style"))).alias("own"))
        options = options.join(own, "category", "left").withColumn("list", F.coalesce("own", every))
    k = F.greatest(F.lit(1), F.least(F.lit(most), F.size("list"), F.floor(F.col("needed") / least).cast("int")))
    base, rest = F.floor(F.col("needed") / F.col("k")).cast("int"), (F.col("needed") % F.col("k")).cast("int")
    spread = options.where(F.size("list") > 0).withColumn("k", k).select("category", "needed", "k", F.posexplode(F.slice("list", 1, F.col("k"))).alias("style_pos", "s"))
    return spread.select("category", F.col("s.style").alias("style"), F.col("style_pos").cast("int").alias("style_pos"), (base + F.when(F.col("style_pos") < rest, 1).otherwise(0)).alias("needed"))


def style_allocation(limits: list[tuple[str, float]], presets: list[str], total: int, categories: int) -> dict[str, int]:
    """Overall allotment by share limits: a fold in the order of the limits, as each takes from what the ones before leave.

    A style gets at most the share of what is left that one preset has. A positive remainder is spread over the presets, in their order. Divisions round down, below zero too.
    """
    left, out = total, {}
    for style, limit in limits:
        out[style] = max(max(5, categories // 2), min(int(total * limit), left // len(presets)))
        left -= out[style]
    if left > 0:
        for i, style in enumerate(presets):
            out[style] = out.get(style, 0) + left // len(presets) + (i < left % len(presets))
    return out


def batches(matrix: DataFrame, per_request: int = 3) -> DataFrame:
    """A row for each request: ``batch_idx`` from 0, enough of them for ``needed``."""
    last = F.ceil(F.col("needed") / per_request).cast("int") - 1
    return matrix.where("needed > 0").withColumn("batch_idx", F.explode(F.sequence(F.lit(0), last)))


def clusters(n: Column) -> Column:
    """Number of clusters for ``n`` rows."""
    return F.least(F.lit(6), F.greatest(F.lit(3), F.floor(F.sqrt(n / 3)).cast("int")), n.cast("int"))


def needed_by_category(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("category").agg(F.sum("needed").alias("needed"))
