import pytest
from hypothesis import given
from hypothesis import strategies as st

from tsumugi.operators import allocate

STYLES = "pos int, name string"
NEEDS = "category string, needed int"


def matrix(spark, needs, n_styles, allowed=None):
    styles = spark.createDataFrame([(i, f"s{i:02}") for i in range(n_styles)], STYLES)
    allowed = spark.createDataFrame(allowed, "category string, pos int, style string") if allowed is not None else None
    rows = allocate.style_matrix(spark.createDataFrame(needs, NEEDS), styles, allowed).orderBy("category", "style_pos").collect()
    out = {}
    for r in rows:
        out.setdefault(r["category"], []).append(r["needed"])
    return out


GOLDEN = {1: [1], 4: [4], 9: [9], 10: [5, 5], 14: [7, 7], 24: [6, 6, 6, 6], 25: [5] * 5, 56: [12, 11, 11, 11, 11], 99: [20, 20, 20, 20, 19]}


def test_matrix_golden(spark):
    needs = [(f"c{n:03}", n) for n in [0, *GOLDEN]]
    assert matrix(spark, needs, 11) == {f"c{n:03}": v for n, v in GOLDEN.items()}
    one = [(f"c{n:03}", 0, "only") for n in [0, *GOLDEN]]
    assert matrix(spark, needs, 11, one) == {f"c{n:03}": [n] for n in GOLDEN}


def test_matrix_without_rows_styles_or_needs(spark):
    assert matrix(spark, [], 3) == {}
    assert matrix(spark, [("a", 5)], 0) == {}
    assert matrix(spark, [("a", 7)], 2, []) == {"a": [7]}


def test_matrix_properties(spark):
    needs = [(f"c{n}", n) for n in range(0, 150, 7)]
    found = matrix(spark, needs, 11)
    for c, n in needs:
        assert sum(found.get(c, [])) == n
        assert not found.get(c) or max(found[c]) - min(found[c]) <= 1


def test_batches(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 3)], NEEDS)
    assert sorted((r["category"], r["batch_idx"]) for r in allocate.batches(df).collect()) == [("a", 0), ("a", 1), ("a", 2), ("c", 0)]


@pytest.mark.parametrize("n,k", [(1, 1), (2, 2), (3, 3), (4, 3), (47, 3), (48, 4), (74, 4), (75, 5), (107, 5), (108, 6), (1000, 6)])
def test_clusters(spark, n, k):
    from tsumugi.operators.represent import k_for

    assert spark.createDataFrame([(n,)], "n int").select(allocate.clusters(__import__("pyspark.sql.functions", fromlist=["col"]).col("n"))).first()[0] == k == k_for(n)


LIMITS = [(f"s{i}", x) for i, x in enumerate((0.30, 0.28, 0.26, 0.24, 0.22, 0.20, 0.18, 0.16, 0.14, 0.12, 0.10))]


def test_style_allocation_folds_in_order():
    names = [s for s, _ in LIMITS]
    left = 1000 - sum([90, 82, 75, 68, 62, 56, 51, 46, 42, 38, 35])
    assert left == 355
    made = allocate.style_allocation(LIMITS, names, 1000, 10)
    assert list(made.values()) == [a + 32 + (i < 3) for i, a in enumerate([90, 82, 75, 68, 62, 56, 51, 46, 42, 38, 35])]
    assert set(allocate.style_allocation(LIMITS, names, 100, 96).values()) == {48}


@given(st.integers(0, 5000), st.integers(1, 100))
def test_style_allocation_hands_out_all_or_more(total, categories):
    assert sum(allocate.style_allocation(LIMITS, [s for s, _ in LIMITS], total, categories).values()) >= total
