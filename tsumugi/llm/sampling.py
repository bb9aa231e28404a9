"""Problem 1: samples whose category shares follow given targets.

Quotas are allocated top-down over a category tree: each stratum asks for its share, at least its minimum; what a stratum can't
supply goes to its siblings, then to its cousins, then to any stratum with rows to spare. Rows are drawn at the leaves by their
dense rank in a hash permutation. The rank is never taken over a whole stratum: counts of hash cells give the cell in which
the quota ends, and only rows of one cell are ranked together, so that a stratum with a third of all rows is many small tasks.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsumugi.llm.common import only, trimmed

#: Hash cells of a stratum; a cell of a stratum of a billion rows has a quarter of a million.
CELLS = 4096
#: Requests of one table and field are a list in the plan; more of them are an error.
MOST_REQUESTS = 1000
REPORT = "request_id long, stratum string, parent string, grandparent string, sample_size long, target_share double, min_rows long, available long, required double, allocated long, received long, unmet double, met boolean"


def whole_quotas(shares: pd.Series, total: int, caps: pd.Series) -> pd.Series:
    """Whole numbers in proportion to ``shares`` that add up to ``total``, none above its cap, by largest remainder; rest unmet."""
    got = pd.Series(0, index=shares.index, dtype="int64")
    while (left := int(total - got.sum())) > 0:
        free = shares.where(got < caps, 0.0)
        if free.sum() <= 0:
            free = (caps - got).clip(lower=0).astype(float)
            if free.sum() <= 0:
                break
        exact = free / free.sum() * left
        add = exact.astype("int64")
        short = left - int(add.sum())
        order = (exact - add).where(free > 0, -1.0).sort_values(ascending=False, kind="stable").index[:short]
        add[order] += (free[order] > 0).astype("int64")
        add = add.clip(upper=caps - got)
        if add.sum() == 0:
            break
        got += add
    return got


def allocate(strata: pd.DataFrame) -> pd.DataFrame:
    """Rows to draw from each stratum of one request. Minimums come first and are scaled down if they exceed the sample."""
    s = strata.sort_values("stratum", kind="stable").reset_index(drop=True)
    size = int(s.sample_size.iloc[0])
    share = s.target_share.fillna(0.0).clip(lower=0.0).astype(float)
    cap = s.available.astype("int64")
    floor = s.min_rows.fillna(0).clip(lower=0).astype("int64").clip(upper=cap)
    if floor.sum() > size:
        floor = whole_quotas(floor.astype(float), size, floor)
    wish = whole_quotas(share, size, pd.Series(size, index=s.index))
    # strata whose minimum exceeds their share take it from the others' surplus in proportion
    base = pd.concat([wish, floor], axis=1).max(axis=1).clip(upper=cap)
    over = int(base.sum() - size)
    if over > 0:
        spare = base - floor
        base = base - whole_quotas(spare.astype(float), over, spare)
    received = pd.Series(0, index=s.index, dtype="int64")
    if wish.sum() > 0:
        unmet = (wish - base).clip(lower=0)
        room = min(int(unmet.sum()), int(size - base.sum()))
        for level in ("parent", "grandparent", None):  # siblings, cousins, anyone
            for _, group in [(None, s)] if level is None else s.groupby(level, dropna=False, sort=True):
                at = group.index
                give = whole_quotas(share[at], min(int(unmet[at].sum()), room), (cap - base)[at].clip(lower=0))
                base[at] += give
                received[at] += give
                room -= int(give.sum())
                left = int(unmet[at].sum() - give.sum())
                unmet[at] = whole_quotas(unmet[at].astype(float), left, unmet[at])
    s["allocated"], s["received"] = base, received
    # what a stratum's own quota, before anything is passed on or received, leaves unmet
    s["required"] = [max(float(m), t * n) for m, t, n in zip(s.min_rows.fillna(0), share, s.sample_size)]
    s["unmet"] = (s.required - cap).clip(lower=0.0)
    s["met"] = s.unmet <= 0
    return s


def strata_of(df: DataFrame, key: str, field: str) -> DataFrame:
    """``key, stratum``: each key once, with its field without white space around it; null and blank fields belong to no stratum."""
    return only(df.where(df[key].isNotNull()), key=key, stratum=trimmed(df[field])).where("stratum <> ''").groupBy("key").agg(F.min("stratum").alias("stratum"))


def sampling_report(counts: DataFrame, requests: DataFrame, targets: DataFrame, tree: DataFrame | None = None) -> DataFrame:
    """What each stratum of each request has, needs and gets: the columns of ``REPORT``.

    ``counts``: ``request_id, stratum, available``. ``targets``: ``request_id, stratum, target_share, min_rows``; repeats count
    once. ``tree``: ``stratum, parent, grandparent``; strata outside it are siblings of each other. ``unmet`` is by how many rows a
    stratum falls short of the larger of ``min_rows`` and ``target_share * sample_size``; ``met`` tells that it doesn't.
    """
    tree = tree if tree is not None else counts.sparkSession.createDataFrame([], "stratum string, parent string, grandparent string")
    wanted = targets.select(F.col("request_id").cast("long").alias("request_id"), "stratum", F.col("target_share").cast("double").alias("target_share"), F.col("min_rows").cast("long").alias("min_rows")).where("stratum is not null").dropDuplicates(["request_id", "stratum"])
    sized = requests.select(F.col("request_id").cast("long").alias("request_id"), F.col("sample_size").cast("long").alias("sample_size")).where("sample_size >= 0").dropDuplicates(["request_id"])
    tree = tree.select("stratum", "parent", "grandparent").dropDuplicates(["stratum"])
    full = wanted.join(sized, "request_id").join(tree, "stratum", "left").join(counts, ["request_id", "stratum"], "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("long"))
    names = [c.split()[0] for c in REPORT.split(", ")]
    return full.groupBy("request_id").applyInPandas(lambda pdf: allocate(pdf)[names], REPORT)  # a group is the strata of one request


def draw(rows: DataFrame, quotas: DataFrame, seed: int = 0) -> DataFrame:
    """``request_id, key, stratum, draw_rank``: of each stratum the first ``allocated`` rows of a permutation by hash.

    ``rows``: ``request_id, key, stratum``. The rank is dense over distinct keys, from 1; ties of the hash go by key.
    """
    order: Column = F.xxhash64(F.lit(seed), "request_id", "key")
    placed = rows.withColumn("place", order).withColumn("cell", F.pmod(F.shiftrightunsigned("place", 40), F.lit(CELLS)))
    cells = placed.groupBy("request_id", "stratum", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("request_id", "stratum").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most CELLS rows
    cut = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(quotas.select("request_id", "stratum", "allocated"), ["request_id", "stratum"]).where("before < allocated").select("request_id", "stratum", "cell", "before", "allocated")
    kept = placed.join(cut, ["request_id", "stratum", "cell"])
    inner = Window.partitionBy("request_id", "stratum", "cell").orderBy("place", "key")
    return kept.withColumn("draw_rank", F.col("before") + F.row_number().over(inner)).where("draw_rank <= allocated").select("request_id", "key", "stratum", F.col("draw_rank").cast("long").alias("draw_rank"))


def request_ids(requests: DataFrame, name: str, field: str):
    """The requests of one table and field as an array in the plan, which multiplies rows without a join."""
    found = requests.where((F.col("table_name") == name) & (F.col("field") == field) & F.col("request_id").isNotNull()).select(F.col("request_id").cast("long")).distinct().limit(MOST_REQUESTS + 1).collect()
    if len(found) > MOST_REQUESTS:
        raise ValueError(f"more than {MOST_REQUESTS} requests of {name}.{field}")
    return F.explode(F.array(*[F.lit(r[0]) for r in sorted(found)]).cast("array<bigint>")).alias("request_id")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def requested(sources: dict[tuple[str, str], tuple[DataFrame, str]], requests: DataFrame) -> DataFrame:
    """``request_id, key, stratum`` of all rows each request may draw; ``sources``: by table and field the table and its key."""
    return _union([strata_of(df, key, field).select(request_ids(requests, *of), "key", "stratum") for of, (df, key) in sources.items() for field in of[1:]])


def available(sources: dict[tuple[str, str], tuple[DataFrame, str]], requests: DataFrame) -> DataFrame:
    """``request_id, stratum, available``: distinct keys of each stratum; each table is counted once, however many requests."""
    return _union([strata_of(df, key, field).groupBy("stratum").agg(F.count("*").alias("available")).select(request_ids(requests, *of), "stratum", "available") for of, (df, key) in sources.items() for field in of[1:]])
