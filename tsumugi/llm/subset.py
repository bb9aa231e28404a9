"""Problem 5: a varied subset, by systematic selection along a Hilbert curve.

A record's place is its category's level, one of its own, and four projections of its body's trigrams, quantised by all rows' mean
and spread, in levels so fine that a category has at least ``CELLS_A_ROW`` cells for each row asked for. Near copies have nearly the same projections, so a recurring story, however large, fills few cells. The distinct cells are
sorted by their key on the curve; evenly spaced ones are chosen, and the best record of each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsumugi.llm.codes import code_points, gram_hashes, inside, mix
from tsumugi.llm.common import chunked, only, stage, texts_of, trimmed
from tsumugi.llm.sampling import MOST_REQUESTS
from tsumugi.llm.shingles import compact, text_hashes

#: Bits of an axis at most: a key has five axes.
PROJECTIONS, CELLS_A_ROW, MOST_BITS = 4, 4, 12
#: Cells with the same upper bits of the key are sorted together; there are so many such ranges.
RANGES = 4096
ROWS, SALTS = 500, 64


def hilbert(levels: np.ndarray, bits: int) -> np.ndarray:
    """Key on the Hilbert curve of each row of ``levels`` (points by dimensions, each below 2**bits)."""
    x = levels.astype(np.int64).T.copy()
    dims = len(x)
    for shift in range(bits - 1, 0, -1):  # undo the turns of the curve, from the largest cube down
        low = (1 << shift) - 1
        for i in range(dims):
            high = (x[i] >> shift) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> shift) & 1 == 1, (1 << shift) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> shift) & 1
    return key


def projections(texts: list[str]) -> np.ndarray:
    """Sums of random signs of each text's trigrams, by the root of their number."""
    points, offsets = code_points([compact(t) for t in texts])
    grams, sizes = gram_hashes(points, 3), np.maximum(np.diff(offsets) - 2, 0)
    ok, out, full = inside(offsets, 3, len(points)), np.zeros((len(texts), PROJECTIONS)), np.flatnonzero(sizes)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        bits = mix(grams[ok], 21)
        for k in range(PROJECTIONS):
            sign = ((bits >> np.uint64(7 * k + 5)) & np.uint64(1)).astype(np.float64) * 2 - 1
            out[full, k] = np.add.reduceat(sign, starts) / np.sqrt(sizes[full])
    return out


def fineness(size: int, categories: int) -> tuple[int, int]:
    """Bits of the levels of a projection, and of a key's axis, for ``size`` rows to choose of so many categories."""
    levels = min(MOST_BITS, max(2, -(-(CELLS_A_ROW * max(1, size) - 1).bit_length() // PROJECTIONS)))
    return levels, max(levels, min(MOST_BITS, categories.bit_length()))


def placed(df: DataFrame, id_col: str, text_col: str, category_col: str, size: int) -> tuple[DataFrame, int]:
    """``id, category, h1, h2, chars, key``: each id with a body that isn't blank, and its cell's key; and a key's bits.

    ``size``: rows that will be asked for. Categories beyond 2**``MOST_BITS`` share levels with their neighbours.
    """
    source = only(df, id=F.col(id_col).cast("long"), text=text_col, category=trimmed(df[category_col])).where("id is not null and text is not null")
    names = [f"f{k}" for k in range(PROJECTIONS)]

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, ROWS):
            texts = texts_of(batch.column(1))
            h, f = text_hashes([compact(t) for t in texts]).view(np.int64), projections(texts)
            keep = pa.array([bool(t.strip()) for t in texts])
            made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.array([len(t) for t in texts], np.int32)), *(pa.array(f[:, k]) for k in range(PROJECTIONS))], names=["id", "category", "h1", "h2", "chars", *names])
            yield made.filter(keep)

    features = stage(source.mapInArrow(project, "id long, category string, h1 long, h2 long, chars int, " + ", ".join(f"{n} double" for n in names)).dropDuplicates(["id"]), "features")
    stats = features.agg(*[F.avg(n) for n in names], *[F.stddev_pop(n) for n in names]).first()
    mean, spread = np.array([x or 0.0 for x in stats[:PROJECTIONS]]), np.array([x or 1.0 for x in stats[PROJECTIONS:]])
    labels = features.select("category").where("category is not null").distinct()
    fine, bits = fineness(size, count := labels.count())
    ranks = labels.withColumn("level", F.floor(F.row_number().over(Window.orderBy("category")) * F.lit(min(1.0, ((1 << bits) - 1) / max(1, count)))).cast("int"))  # labels are few

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.stack([batch.column(6 + k).to_numpy() for k in range(PROJECTIONS)], axis=1)
            z = (f - mean) / spread
            quantile = 1 / (1 + np.exp(-1.702 * z))  # close to the normal distribution function
            levels = np.minimum((quantile * (1 << fine)).astype(np.int64), (1 << fine) - 1) << (bits - fine)
            key = hilbert(np.column_stack([batch.column(5).to_numpy(), levels]), bits)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(key)], names=["id", "category", "h1", "h2", "chars", "key"])

    full = features.join(ranks, "category", "left").select("id", "category", "h1", "h2", "chars", F.coalesce("level", F.lit(0)).alias("level"), *names)
    return full.mapInArrow(encode, "id long, category string, h1 long, h2 long, chars int, key long"), bits


def varied_subsets(df: DataFrame, id_col: str, text_col: str, category_col: str, requests: DataFrame) -> DataFrame:
    """``request_id, id, cell, cell_rank, rank_in_cell``: for each request (``request_id, category, subset_size``) its subset.

    A null category asks for the whole table. As many rows come out as asked for, or all that qualify: each id once, with a body
    that isn't blank. If there are fewer cells than rows asked for, cells give a second record and so on, evenly; within a cell
    different bodies go before copies, longer ones (up to 600 characters) before shorter ones, then lesser ids. Requests are a
    list in the plan, ``MOST_REQUESTS`` at most.
    """
    asked = requests.where("request_id is not null and subset_size > 0").select(F.col("request_id").cast("long"), trimmed(F.col("category")), F.col("subset_size").cast("long")).distinct().limit(MOST_REQUESTS + 1).collect()
    if len(asked) > MOST_REQUESTS:
        raise ValueError(f"more than {MOST_REQUESTS} requests")
    kind = "array<struct<request_id:bigint,wanted:string,size:bigint>>"
    listed = F.from_json(F.lit("[" + ",".join(f'{{"request_id":{r[0]},"wanted":{_json(r[1])},"size":{r[2]}}}' for r in sorted(asked, key=lambda r: r[0])) + "]"), kind)
    rows, bits = placed(df, id_col, text_col, category_col, max([r[2] for r in asked], default=1))
    rows = stage(rows, "placed")
    first = rows.groupBy("h1", "h2").agg(F.min("id").alias("first_id"))
    quality = F.least("chars", F.lit(600))
    ranked = rows.join(first, ["h1", "h2"]).select("id", "category", "key", F.struct((F.col("id") != F.col("first_id")).alias("copy"), (-quality).alias("q"), F.col("id").alias("id")).alias("order"))
    wide = ranked.withColumn("r", F.explode(F.filter(listed, lambda r: r["wanted"].isNull() | (r["wanted"] == F.col("category"))))).select("r.request_id", "r.size", "key", "order")
    cells = stage(wide.groupBy("request_id", "size", "key").agg(F.count("*").alias("n"), F.min("order").alias("best")), "cells")

    # rank of each cell along the curve: cells of earlier ranges, then those before it in its own
    span = F.lit(max(1, (1 << bits * (PROJECTIONS + 1)) // RANGES))
    ranged = cells.withColumn("range", F.floor(F.col("key") / span))
    before = Window.partitionBy("request_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES rows
    starts = ranged.groupBy("request_id", "range").agg(F.count("*").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).select("request_id", "range", "before")
    in_range = Window.partitionBy("request_id", "range").orderBy("key")
    numbered = ranged.join(starts, ["request_id", "range"]).withColumn("cell_rank", F.col("before") + F.row_number().over(in_range) - 1)
    totals = _levels(cells)
    placed_cells = numbered.join(totals, "request_id")
    # full rounds give a record of each cell that still has one; the last round's are evenly spaced among the cells that have one more
    more = placed_cells.withColumn("open", (F.col("n") > F.col("rounds")).cast("long"))
    open_before = Window.partitionBy("request_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    open_starts = more.groupBy("request_id", "range").agg(F.sum("open").alias("o")).withColumn("open_before", F.coalesce(F.sum("o").over(open_before), F.lit(0))).select("request_id", "range", "open_before")
    running = F.col("open_before") + F.sum("open").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("open")
    spaced = F.floor((running + 1) * F.col("extra") / F.col("open_cells")) > F.floor(running * F.col("extra") / F.col("open_cells"))
    quota = F.least("n", F.col("rounds")) + F.when((F.col("open") == 1) & (F.col("extra") > 0) & spaced, 1).otherwise(0)
    quotas = more.join(open_starts, ["request_id", "range"]).withColumn("quota", quota).where("quota > 0").select("request_id", "key", "cell_rank", "quota", "best")
    quotas = stage(quotas, "quotas")
    singles = quotas.where("quota = 1").select("request_id", F.col("best.id").alias("id"), F.col("key").alias("cell"), "cell_rank", F.lit(1).cast("long").alias("rank_in_cell"))
    several = wide.join(quotas.where("quota > 1").drop("best"), ["request_id", "key"]).withColumn("salt", F.pmod(F.hash("order.id"), F.lit(SALTS)))
    part = Window.partitionBy("request_id", "key", "salt").orderBy("order")
    whole = Window.partitionBy("request_id", "key").orderBy("order")
    several = several.withColumn("k", F.row_number().over(part)).where("k <= quota").withColumn("rank_in_cell", F.row_number().over(whole)).where("rank_in_cell <= quota")
    return singles.unionByName(several.select("request_id", F.col("order.id").alias("id"), F.col("key").alias("cell"), "cell_rank", F.col("rank_in_cell").cast("long").alias("rank_in_cell")))


def _levels(cells: DataFrame) -> DataFrame:
    """``request_id, rounds, extra, open_cells``: records that every cell gives, and how many more come from the cells with more."""
    sizes = cells.groupBy("request_id", "size", "n").agg(F.count("*").alias("c"))
    total, less = Window.partitionBy("request_id"), Window.partitionBy("request_id").orderBy("n")
    # up to round n all cells with n or more give: given(n) = sum over smaller m of m*c + n * (cells with n or more)
    steps = sizes.withColumn("cells", F.sum("c").over(total)).withColumn("upto", F.sum("c").over(less)).withColumn("small", F.sum(F.col("n") * F.col("c")).over(less))
    steps = steps.withColumn("left", F.col("cells") - F.col("upto")).withColumn("given", F.col("small") + F.col("n") * F.col("left"))
    # the last step not beyond the size; before the first step nothing is given and all cells are open
    zero = steps.groupBy("request_id", "size").agg(F.max("cells").alias("left")).select("request_id", "size", F.lit(0).cast("long").alias("n"), "left", F.lit(0).cast("long").alias("given"))
    base = steps.select("request_id", "size", "n", "left", "given").unionByName(zero).where("given <= size").groupBy("request_id", "size").agg(F.max(F.struct("n", "left", "given")).alias("s"))
    rest = F.col("size") - F.col("s.given")
    rounds = F.when(F.col("s.left") > 0, F.floor(rest / F.greatest(F.col("s.left"), F.lit(1)))).otherwise(0)
    return base.select("request_id", (F.col("s.n") + rounds).cast("long").alias("rounds"), F.when(F.col("s.left") > 0, rest - rounds * F.col("s.left")).otherwise(0).cast("long").alias("extra"), F.greatest(F.col("s.left"), F.lit(1)).alias("open_cells"))


def _json(value: str | None) -> str:
    import json

    return json.dumps(value)
