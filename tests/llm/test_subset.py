import random

import numpy as np
import pytest

from tsumugi.llm import subset
from tsumugi.llm.subset import hilbert, varied_subsets

REQUESTS = "request_id int, category string, subset_size bigint"
ROWS = "row_id bigint, body string, category string, id string, cell string"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_all_neighbours_in_turn(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def corpus():
    rng = random.Random(2)
    make = lambda: "".join(rng.choice("日月火水木金土山川田空海東西南北") for _ in range(200))
    story = make()
    rows = [(i, story[:100] + str(i % 7) + story[100:], "a", "x", "y") for i in range(300)]
    rows += [(1000 + i, make(), rng.choice(["a", " b ", None]), "x", "y") for i in range(200)]
    return rows + [(2000, None, "a", "x", "y"), (2001, "", "a", "x", "y"), (2002, " \n", "a", "x", "y"), (2003, "長" * 30_000, "c", "x", "y")]


@pytest.mark.parametrize("partitions", [1, 4])
def test_subsets(spark, partitions):
    rows = corpus()
    df = spark.createDataFrame(rows + rows[:20], ROWS).repartition(partitions)
    requests = spark.createDataFrame([(1, None, 60), (2, "b", 10), (3, None, 10**6), (4, "c", 5), (5, "absent", 5), (6, None, 400), (7, None, 0)], REQUESTS)
    got = {}
    for r in varied_subsets(df, "row_id", "body", "category", requests).collect():
        got.setdefault(r["request_id"], []).append(r)
    ids = {k: {r["id"] for r in v} for k, v in got.items()}
    category = {r[0]: (r[2] or "").strip() for r in rows}
    assert all(len(ids[k]) == len(got[k]) for k in got)
    assert {k: len(v) for k, v in ids.items()} == {1: 60, 2: 10, 3: 501, 4: 1, 6: 400}
    assert all(category[i] == "b" for i in ids[2]) and ids[3] == {r[0] for r in rows if r[1] and r[1].strip()}
    # the story has six tenths of the rows; its cells get their even part only
    assert sum(i < 300 for i in ids[1]) <= 6
    # a seventh of a story's rows differ, so different bodies go before copies even where more is asked for than there are cells
    assert len({rows[i][1] for i in ids[6] if i < 300}) == 7


def test_the_same_whatever_the_partitions(spark):
    requests = spark.createDataFrame([(1, None, 77)], REQUESTS)
    one, four = ({(r["id"], r["cell"]) for r in varied_subsets(spark.createDataFrame(corpus(), ROWS).repartition(n), "row_id", "body", "category", requests).collect()} for n in (1, 4))
    assert one == four


def test_nothing(spark):
    requests = spark.createDataFrame([(1, None, 5)], REQUESTS)
    assert varied_subsets(spark.createDataFrame([], ROWS), "row_id", "body", "category", requests).count() == 0
    assert varied_subsets(spark.createDataFrame(corpus()[:5], ROWS), "row_id", "body", "category", requests.limit(0)).count() == 0


def test_too_many_requests(spark, monkeypatch):
    monkeypatch.setattr(subset, "MOST_REQUESTS", 1)
    with pytest.raises(ValueError):
        varied_subsets(spark.createDataFrame([], ROWS), "row_id", "body", "category", spark.createDataFrame([(1, None, 5), (2, None, 5)], REQUESTS))
