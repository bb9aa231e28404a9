"""Representative rows of each category: features, seeded k-means, the rows nearest to the centres, and a greedy similarity filter."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsumugi.functions.text import digit_class, matches, occurrences
from tsumugi.operators.similarity import cosine

#: Names of the seven counts, in order, and the literals counted.
FEATURES = ("chars", "periods", "commas", "digits", "wa", "ga", "wo")
LITERALS = {"periods": "。", "commas": "、", "wa": "は", "ga": "が", "wo": "を"}
#: Rows of a category that one task clusters; above it, a share by hash gives the first centres and distributed rounds over all rows move them.
LARGE_GROUP = 20_000
#: Rounds of Lloyd's algorithm at most.
ROUNDS = 100
CENTRES = "category string, centres array<struct<cluster:int,centre:array<double>>>"


def feature_columns(text: Column) -> list[Column]:
    made = {"chars": F.length(text), "digits": matches(text, digit_class())} | {name: occurrences(text, c) for name, c in LITERALS.items()}
    return [F.coalesce(made[name], F.lit(0)).cast("int").alias(name) for name in FEATURES]


def features(rows: DataFrame, text: str = "body") -> DataFrame:
    """``rows`` with ``vector``, the seven counts as doubles; a null text has zeros."""
    return rows.withColumn("vector", F.array(*[c.cast("double") for c in feature_columns(F.col(text))]))


def embedded(rows: DataFrame, model: Callable[[pd.Series], list], text: str = "body") -> DataFrame:
    """``rows`` with ``vector`` from a model of the caller's, applied to Arrow batches."""

    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, float).tolist() for v in model(s.fillna(""))])

    return rows.withColumn("vector", run(text))


def nearest_to_centroid(points: DataFrame, group: list[str], id_col: str, vector: str = "vector") -> DataFrame:
    """``group``, ``id_col`` and ``distance`` of each group's member nearest to its mean; of equals the least id.

    Means are averages by dimension, and the nearest is a minimum, both combined before the shuffle; no group is gathered.
    """
    at = points.select(*group, id_col, F.posexplode(vector).alias("dim", "x"))
    means = at.groupBy(*group, "dim").agg(F.avg(F.col("x").cast("double")).alias("m")).groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("centre"))
    apart = F.sqrt(F.aggregate(F.zip_with(F.col(vector), "centre", lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda a, x: a + x))
    best = points.join(means, group).groupBy(*group).agg(F.min(F.struct(F.round(apart, 9).alias("distance"), F.col(id_col).alias("id"))).alias("best"))
    return best.select(*group, F.col("best.id").alias(id_col), F.col("best.distance").alias("distance"))


def k_for(n: int) -> int:
    return min(6, max(3, int((n / 3) ** 0.5)), n)


def kmeans(x: np.ndarray, k: int, seed: int = 42, restarts: int = 10, rounds: int = ROUNDS) -> np.ndarray:
    """Labels of Lloyd's algorithm from k-means++ starts; the best of ``restarts`` by inertia. Same input, same labels."""
    rng, best = np.random.default_rng(seed), (np.inf, None)
    for _ in range(restarts):
        centres = x[[rng.integers(len(x))]]
        while len(centres) < k:
            d = ((x[:, None] - centres[None]) ** 2).sum(-1).min(1)
            centres = np.vstack([centres, x[rng.choice(len(x), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(x))]])
        labels = None
        for _ in range(rounds):
            d = ((x[:, None] - centres[None]) ** 2).sum(-1)
            new = d.argmin(1)
            if labels is not None and (new == labels).all():
                break
            labels = new
            centres = np.stack([x[labels == j].mean(0) if (labels == j).any() else centres[j] for j in range(k)])
        inertia = ((x - centres[labels]) ** 2).sum()
        if inertia < best[0] - 1e-12:
            best = (inertia, labels)
    return best[1]


def mutual_filter(x: np.ndarray, limit: float = 0.90) -> np.ndarray:
    """Which rows stay: of each pair, row by row, at or above ``limit`` the one with the larger sum of similarities goes, of equals the later."""
    n = len(x)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x, dtype=float), where=norm > 0)
    s = u @ u.T
    np.fill_diagonal(s, 0.0)
    alive, sums = np.ones(n, bool), s.sum(1)
    for i in range(n):
        for j in range(n):
            if n > 1 and i != j and alive[i] and alive[j] and s[i, j] >= limit:
                alive[i if sums[i] > sums[j] else j] = False
    return alive


def assigned(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """``rows`` with ``d``, distance and number of the nearest of their category's ``centres``; of equals the least number."""
    apart = lambda c: F.round(F.sqrt(F.aggregate(F.zip_with("vector", c, lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda a, x: a + x)), 9)
    return rows.join(lists, "category").withColumn("d", F.array_min(F.transform("centres", lambda c: F.struct(apart(c["centre"]).alias("distance"), c["cluster"].alias("cluster")))))


def lloyd(rows: DataFrame, lists: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``CENTRES`` after Lloyd's rounds over all ``rows`` from the centres in ``lists``, until none moves; six a category at most.

    A round assigns every row and adds up by category, cluster and dimension before the shuffle; no category is gathered.
    """
    rows = rows.persist()
    now = {(r["category"], c["cluster"]): c["centre"] for r in lists.toLocalIterator() for c in r["centres"]}
    listed = lambda: [(g, [(k, m) for (h, k), m in sorted(now.items()) if h == g]) for g in sorted({g for g, _ in now})]
    for _ in range(rounds):
        at = assigned(rows, F.broadcast(rows.sparkSession.createDataFrame(listed(), CENTRES))).select("category", F.col("d.cluster").alias("cluster"), F.posexplode("vector").alias("dim", "x"))
        moved = {key: [*m] for key, m in now.items()}  # a cluster without rows stays where it is
        for r in at.groupBy("category", "cluster", "dim").agg(F.avg("x").alias("m")).toLocalIterator():
            moved[r["category"], r["cluster"]][r["dim"]] = r["m"]
        still = all(np.allclose(moved[key], now[key], rtol=1e-12, atol=1e-9) for key in now)
        now = moved
        if still:
            break
    rows.unpersist()
    return rows.sparkSession.createDataFrame(listed(), CENTRES)


def central(rows: DataFrame, seed: int = 42, large: int = LARGE_GROUP) -> DataFrame:
    """``category, n, cluster, row_id, vector``: the row nearest to each centre of each category of ``n`` rows; ``rows``: ``category, row_id, vector``.

    Up to three rows all are taken, each its own cluster. Otherwise k-means with ``k_for`` clusters. Categories with more than
    ``large`` rows take their first centres from about that many rows, chosen by a hash of the row id, and move them in
    distributed rounds over all rows (``lloyd``). Null categories are left out, repeats of a row id count once.
    """
    rows = rows.where("category is not null").select("category", "row_id", "vector").dropDuplicates(["row_id"])
    sizes = rows.groupBy("category").agg(F.count("*").alias("n"))
    few = rows.join(sizes.where("n <= 3"), "category").select("category", "n", (F.row_number().over(Window.partitionBy("category").orderBy("row_id")) - 1).alias("cluster"), "row_id", "vector")
    rows, sizes = rows.join(sizes.where("n > 3").select("category"), "category"), sizes.where("n > 3")
    # a share by hash, so that no task ever sees more than about ``large`` rows of a category
    share = F.least(F.lit(1.0), F.lit(float(large)) / F.col("n"))
    fit = rows.join(sizes, "category").where((F.pmod(F.xxhash64("row_id"), F.lit(1 << 20)) / float(1 << 20) < share) | (F.col("n") <= large))

    def centres(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        x, n = np.array(pdf.vector.tolist(), float), int(pdf.n.iloc[0])
        labels = kmeans(x, min(k_for(n), len(x)), seed)
        return pd.DataFrame({"category": pdf.category.iloc[0], "cluster": sorted(set(labels.tolist())), "centre": [x[labels == j].mean(0).tolist() for j in sorted(set(labels.tolist()))]})

    middle = fit.groupBy("category").applyInPandas(centres, "category string, cluster int, centre array<double>")
    lists = middle.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("cluster", "centre"))).alias("centres"))  # six at most
    big = sizes.where(F.col("n") > large).select("category")
    if not big.isEmpty():
        lists = lists.join(big, "category", "left_anti").unionByName(lloyd(rows.join(big, "category"), lists.join(big, "category")))
    best = assigned(rows, lists).groupBy("category", "d.cluster").agg(F.min(F.struct("d.distance", "row_id", "vector")).alias("b")).select("category", "cluster", "b.row_id", "b.vector")
    return few.unionByName(best.join(sizes, "category").select(*few.columns))


def representatives(rows: DataFrame, limit: float = 0.90, seed: int = 42, large: int = LARGE_GROUP) -> DataFrame:
    """``category, row_id, rep_rank`` of each category's representatives: the ``central`` rows that pass the greedy filter.

    All rows of a category of up to three stay.
    """

    def thin(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cluster")
        keep = pdf[mutual_filter(np.array(pdf.vector.tolist(), float), limit)] if pdf.n.iloc[0] > 3 else pdf
        return pd.DataFrame({"category": keep.category, "row_id": keep.row_id, "rep_rank": np.arange(len(keep), dtype=np.int32)})

    # a group is a category's six rows at most
    return central(rows, seed, large).groupBy("category").applyInPandas(thin, "category string, row_id long, rep_rank int")


def shown(valid: DataFrame, limit: float = 0.90, seed: int = 42) -> DataFrame:
    """``category, row_id, rep_rank, title, body`` of the representatives of ``valid`` rows."""
    chosen = representatives(features(valid), limit, seed)
    return valid.select("row_id", "title", "body").dropDuplicates(["row_id"]).join(chosen, "row_id")


def pairwise(rows: DataFrame) -> DataFrame:
    """``category, row_a, row_b, similarity`` (a < b) of a category's ``central`` rows, six at most."""
    other = rows.select("category", F.col("row_id").alias("row_b"), F.col("vector").alias("vb"))
    return rows.join(other, "category").where("row_id < row_b").select("category", F.col("row_id").alias("row_a"), "row_b", cosine(F.col("vector"), F.col("vb")).alias("similarity"))

