import random

import pytest

from tsumugi.llm.spans import shared_spans

SCHEMA = "doc_id bigint, text string, doc bigint, at string, n_chars string"


def brute(rows, span):
    where = {}
    for i, t in rows:
        for k in range(len(t or "") - span + 1):
            where.setdefault(t[k : k + span], set()).add(i)
    out = {}
    for i, t in rows:
        if t is not None:
            covered = {p for k in range(len(t) - span + 1) if len(where[t[k : k + span]]) > 1 for p in range(k, k + span)}
            out[i] = (len(t), len(covered))
    return out


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("あいうえおかきくけこabc😀\n ") for _ in range(n))
    note, other = make(40), make(25)
    texts = [make(rng.randrange(0, 90)) for _ in range(30)]
    for k in range(0, 20):
        texts[k] += (note if k % 2 else note[: 19 + k]) + make(5)
    return [(i, t) for i, t in enumerate([*texts, other, other + "x", "z" * 100, "z" * 60, note * 3, None, "", "a" * 20])]


@pytest.mark.parametrize("partitions", [1, 4])
@pytest.mark.parametrize("span", [20, 21])
def test_equals_brute_force(spark, span, partitions):
    rows = corpus(span)
    df = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows + rows[:6]], SCHEMA).repartition(partitions)
    got = {r["doc_id"]: (r["n_chars"], r["shared_chars"]) for r in shared_spans(df, "doc_id", "text", span).collect()}
    assert got == brute(rows, span)


def test_hot_span_and_repeats_within_a_text(spark):
    note = "".join(chr(0x3042 + i % 80) for i in range(220))
    rows = [(i, f"{i}番" + note) for i in range(200)] + [(500, "単独" * 300), (501, "x" * 50_000)]
    got = {r["doc_id"]: r["shared_chars"] for r in shared_spans(spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], SCHEMA), "doc_id", "text").collect()}
    assert all(got[i] >= 220 for i in range(200)) and got[500] == got[501] == 0


def test_empty(spark):
    assert shared_spans(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0
    assert shared_spans(spark.createDataFrame([(1, None, 1, "", "")], SCHEMA), "doc_id", "text").count() == 0
