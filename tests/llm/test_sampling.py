import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tsumugi.llm import sampling

TREE = "stratum string, parent string, grandparent string"


def strata(rows, size):
    """rows: stratum, parent, grandparent, share, minimum, available."""
    return pd.DataFrame([(1, s, p, g, size, t, m, a) for s, p, g, t, m, a in rows], columns=["request_id", "stratum", "parent", "grandparent", "sample_size", "target_share", "min_rows", "available"])


def test_unmet_quota_goes_to_siblings_then_cousins():
    rows = [("a", "p", "g", 0.5, 0, 10), ("b", "p", "g", 0.2, 0, 30), ("c", "q", "g", 0.2, 0, 100), ("d", "r", "h", 0.1, 0, 100)]
    got = sampling.allocate(strata(rows, 100)).set_index("stratum")
    assert got.allocated.to_dict() == {"a": 10, "b": 30, "c": 50, "d": 10}
    assert got.received.to_dict() == {"a": 0, "b": 10, "c": 30, "d": 0}
    assert got.met.to_dict() == {"a": False, "b": True, "c": True, "d": True}


def test_minimums_come_first():
    got = sampling.allocate(strata([("a", "p", "g", 0.9, 0, 1000), ("b", "p", "g", 0.1, 40, 1000)], 100)).set_index("stratum")
    assert got.allocated.to_dict() == {"a": 60, "b": 40}
    got = sampling.allocate(strata([("a", "p", "g", 0.5, 80, 100), ("b", "p", "g", 0.5, 80, 100)], 100))
    assert got.allocated.sum() == 100


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.sampled_from("pq"), st.sampled_from("gh"), st.floats(0, 1), st.integers(0, 30), st.integers(0, 60)), min_size=1, max_size=8), st.integers(0, 150))
def test_allocation_properties(rows, size):
    frame = strata([(f"s{i}", *r) for i, r in enumerate(rows)], size)
    got = sampling.allocate(frame)
    assert (got.allocated <= got.available).all() and (got.allocated >= 0).all()
    total = min(size, int(got.available.sum()))
    assert got.allocated.sum() <= size
    if got.target_share.sum() > 0:
        assert got.allocated.sum() == total
    if got.min_rows.clip(upper=got.available).sum() <= size:
        assert (got.allocated >= got.min_rows.clip(upper=got.available)).all()


def test_sample_and_report(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CELLS", 8)
    rows = [(i, ["a", " a　", "b", None, " "][i % 5], "x") for i in range(500)]
    df = spark.createDataFrame(rows + rows[:50], "row_id bigint, category string, key string")
    sources = {("t", "category"): (df, "row_id")}
    requests = spark.createDataFrame([(1, "t", "category", 120), (2, "t", "category", 400), (3, "other", "category", 5)], "request_id int, table_name string, field string, sample_size bigint")
    targets = spark.createDataFrame([(1, "a", 0.5, 0), (1, "b", 0.5, 0), (2, "a", 0.4, 0), (2, "b", 0.2, 150), (2, "none", 0.4, 1)], "request_id int, stratum string, target_share double, min_rows bigint")
    report = sampling.sampling_report(sampling.available(sources, requests), requests, targets)
    got = {(r["request_id"], r["stratum"]): (r["available"], r["allocated"], r["met"]) for r in report.collect()}
    assert got == {(1, "a"): (200, 60, True), (1, "b"): (100, 60, True), (2, "a"): (200, 200, True), (2, "b"): (100, 100, False), (2, "none"): (0, 0, False)}
    drawn = sampling.draw(sampling.requested(sources, requests), report).collect()
    assert len({(r["request_id"], r["key"]) for r in drawn}) == len(drawn) == 420
    field = {i: (c or "").strip() for i, c, _ in rows}
    for key, (_, n, _) in got.items():
        ranks = sorted(r["draw_rank"] for r in drawn if (r["request_id"], r["stratum"]) == key)
        assert ranks == list(range(1, n + 1))
    assert all(field[r["key"]] == r["stratum"] for r in drawn)
    again = sampling.draw(sampling.requested({("t", "category"): (df.repartition(7), "row_id")}, requests), report).collect()
    assert {(r["request_id"], r["key"]) for r in again} == {(r["request_id"], r["key"]) for r in drawn}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "row_id bigint, category string")
    requests = spark.createDataFrame([(1, "t", "category", 5)], "request_id int, table_name string, field string, sample_size bigint")
    targets = spark.createDataFrame([(1, "a", 1.0, 0)], "request_id int, stratum string, target_share double, min_rows bigint")
    sources = {("t", "category"): (empty, "row_id")}
    report = sampling.sampling_report(sampling.available(sources, requests), requests, targets)
    assert [(r["available"], r["met"]) for r in report.collect()] == [(0, False)]
    assert sampling.draw(sampling.requested(sources, requests), report).count() == 0
    assert sampling.sampling_report(sampling.available(sources, requests.limit(0)), requests.limit(0), targets).count() == 0


def test_too_many_requests_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MOST_REQUESTS", 1)
    requests = spark.createDataFrame([(1, "t", "f"), (2, "t", "f")], "request_id int, table_name string, field string")
    with pytest.raises(ValueError):
        sampling.request_ids(requests, "t", "f")
