import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tsumugi.operators import represent

POINTS = "category string, row_id bigint, vector array<double>"


def test_features(spark):
    df = spark.createDataFrame([(1, "あは、がを。1２³は"), (2, None), (3, "")], "row_id bigint, body string")
    got = {r["row_id"]: tuple(r)[1:] for r in df.select("row_id", *represent.feature_columns(df["body"])).collect()}
    assert got == {1: (10, 1, 1, 3, 2, 1, 1), 2: (0,) * 7, 3: (0,) * 7}


def test_nearest_takes_the_least_id_of_equals(spark):
    df = spark.createDataFrame([("a", 3, [0.0, 0.0]), ("a", 2, [2.0, 0.0]), ("b", 9, [1.0, 1.0])], POINTS)
    assert sorted((r[0], r[1], r[2]) for r in represent.nearest_to_centroid(df, ["category"], "row_id").collect()) == [("a", 2, 1.0), ("b", 9, 0.0)]


def test_mutual_filter():
    x = np.array([[1, 0], [1, 0.01], [0, 1]], float)
    assert represent.mutual_filter(x).tolist() in ([True, False, True], [False, True, True])
    assert represent.mutual_filter(np.array([[1.0, 0], [1.0, 0]])).tolist() == [True, False]
    assert represent.mutual_filter(x[:1]).tolist() == [True]


@settings(deadline=None, max_examples=30)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=2, max_size=12))
def test_filter_leaves_no_similar_pair(rows):
    x = np.array(rows, float)
    keep = x[represent.mutual_filter(x)]
    norm = np.linalg.norm(keep, axis=1)
    s = np.divide(keep @ keep.T, np.outer(norm, norm), out=np.zeros((len(keep),) * 2), where=np.outer(norm, norm) > 0)
    np.fill_diagonal(s, 0)
    assert len(keep) >= 1 and (s < 0.9 + 1e-9).all()


def test_kmeans_is_repeatable_and_finds_clumps():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.1, (20, 2)) for c in (0, 5, 10)])
    labels = represent.kmeans(x, 3)
    assert (labels == represent.kmeans(x, 3)).all() and all(len(set(labels[i : i + 20])) == 1 for i in (0, 20, 40)) and len(set(labels)) == 3


@pytest.mark.parametrize("partitions", [1, 4])
def test_representatives(spark, partitions):
    rows = [("few", i, [1.0, 1.0]) for i in range(3)] + [("many", 10 + i, [float(i % 3 == 0), float(i % 3 == 1)]) for i in range(30)] + [(None, 99, [1.0, 1.0])]
    df = spark.createDataFrame(rows + rows[:5], POINTS).repartition(partitions)
    got = sorted((r["category"], r["row_id"]) for r in represent.representatives(df).collect())
    assert [r for r in got if r[0] == "few"] == [("few", 0), ("few", 1), ("few", 2)]
    many = [i for c, i in got if c == "many"]
    assert many == [10, 11, 12]
    assert represent.representatives(spark.createDataFrame([], POINTS)).count() == 0


def brute_central(pdf):
    """Rows nearest to the k-means centres of each category, row by row."""
    out = {}
    for category, rows in pdf.sort_values("row_id").groupby("category"):
        x = np.array(rows.vector.tolist(), float)
        labels = represent.kmeans(x, represent.k_for(len(x))) if len(x) > 3 else np.arange(len(x))
        chosen = []
        for j in sorted(set(labels.tolist())):
            centre = x[labels == j].mean(0)
            # any row of the category may be the nearest to a centre, but each centre keeps those assigned to it
            own = [i for i in range(len(x)) if labels[i] == j]
            chosen.append(min(own, key=lambda i: (round(float(np.sqrt(((x[i] - centre) ** 2).sum())), 9), int(rows.row_id.iloc[i]))))
        out[category] = [(int(rows.row_id.iloc[i]), x[i]) for i in chosen]
    return out


def test_pairs_and_examples_come_from_the_representatives(spark):
    """Clumps far apart, so that assignment by centres and by labels is the same; brute force over all rows."""
    rng = np.random.default_rng(3)
    rows = [(c, 1000 * k + i, (rng.uniform(-1, 1, 7) + 50 * np.eye(7)[i % 4]).round(3).tolist()) for k, (c, n) in enumerate((("a", 41), ("b", 17), ("c", 3), ("d", 1))) for i in range(n)]
    df = spark.createDataFrame(rows + rows[:7], POINTS).repartition(3)
    expected = brute_central(df.toPandas().drop_duplicates("row_id"))
    got = represent.central(df).collect()
    assert {c: [r["row_id"] for r in sorted(got, key=lambda r: r["cluster"]) if r["category"] == c] for c in "abcd"} == {c: [i for i, _ in v] for c, v in expected.items()}
    cos = lambda x, y: float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))
    pairs = {(c, i, j): round(cos(x, y), 6) for c, v in expected.items() for i, x in v for j, y in v if i < j}
    assert {tuple(r)[:3]: round(r["similarity"], 6) for r in represent.pairwise(represent.central(df)).collect()} == pairs and len(pairs) > 6
    kept = {c: [i for (i, _), ok in zip(v, represent.mutual_filter(np.array([x for _, x in v]))) if ok or len(v) <= 3] for c, v in expected.items()}
    ranked = represent.representatives(df).orderBy("category", "rep_rank").collect()
    assert {c: [r["row_id"] for r in ranked if r["category"] == c] for c in "abcd"} == kept


def test_large_categories_fit_on_a_bounded_part(spark):
    df = spark.createDataFrame([("c", i, [float(i % 2), float(i % 2 == 0)]) for i in range(400)], POINTS)
    got = represent.representatives(df, large=50).collect()
    assert 1 <= len(got) <= 6 and len({r["row_id"] for r in got}) == len(got)


def test_large_categories_take_their_centres_from_all_rows(spark):
    """Six clumps far apart: the representatives are the rows nearest to the means of all rows of each."""
    rng = np.random.default_rng(5)
    x = np.concatenate([100.0 * np.eye(6)[k] + rng.uniform(-9, 9, (n, 6)) for k, n in enumerate((90, 80, 70, 60, 50, 50))]).round(3)
    df = spark.createDataFrame([("c", i, v.tolist()) for i, v in enumerate(x)], POINTS)
    ends = np.cumsum([0, 90, 80, 70, 60, 50, 50])
    nearest = {int(a + ((x[a:b] - x[a:b].mean(0)) ** 2).sum(1).argmin()) for a, b in zip(ends[:-1], ends[1:])}
    assert {r["row_id"] for r in represent.representatives(df, limit=2.0, large=100).collect()} == nearest
