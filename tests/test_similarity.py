import math
import re
from collections import Counter

import pytest

from tsumugi.operators.similarity import cosines, overlaps

TEXTS = "id bigint, category string, text string, other int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], TEXTS)


@pytest.mark.parametrize("text,references,expected", [("abcdef", ["abcdef"], 1.0), ("abcdef", ["abcdxx"], 1 / 3), ("abc", ["abcdef"], 0.0), ("abcdef", [], 0.0), ("ab cd\nef", ["abcdef"], 1.0), ("abcd\tef", ["abcdef"], 0.25), ("abcdef", ["abc"], 0.0), ("abcd", ["abcdefgh"], 1.0), ("", ["abcd"], 0.0), (None, ["abcd"], 0.0)])
def test_overlap_golden(spark, text, references, expected):
    found = overlaps(frame(spark, [(1, "c", text)]), frame(spark, [(i, "c", r) for i, r in enumerate(references)]))
    assert found.collect()[0]["overlap"] == pytest.approx(expected)


def brute_cosine(text, references):
    def terms(t):
        t = re.sub(r"\s\s+", " ", t.lower())
        return Counter(t[i : i + n] for n in (2, 3) for i in range(len(t) - n + 1))

    docs = [terms(text), *map(terms, references)]
    df = Counter(g for d in docs for g in d)
    idf = {g: math.log((1 + len(docs)) / (1 + n)) + 1 for g, n in df.items()}
    vectors = [{g: n * idf[g] for g, n in d.items()} for d in docs]
    norms = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    return max((sum(x * v.get(g, 0) for g, x in vectors[0].items()) / norms[0] / n for v, n in zip(vectors[1:], norms[1:]) if n and norms[0]), default=0.0)


REFERENCES = ["新工場の建設を発表した。", "Aa  bB cc新工場", "価格改定を見送ると述べた。", "", "ab", "新工場の建設を発表した。"]


@pytest.mark.parametrize("partitions", [1, 5])
def test_cosine_equals_a_refit_for_each_candidate(spark, partitions):
    texts = ["新工場の建設を見送る。", "aa bb", "価格", "", None, "全く別の文章である。", "新工場の建設を発表した。"]
    found = cosines(frame(spark, [(i, "c", t) for i, t in enumerate(texts)] * 2).repartition(partitions), frame(spark, [(i, "c", r) for i, r in enumerate(REFERENCES)]).repartition(partitions))
    got = {r["id"]: r["cosine"] for r in found.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(brute_cosine(t or "", REFERENCES), abs=1e-9)


def test_many_tiles_equal_few(spark, monkeypatch):
    from tsumugi.operators import similarity

    left = frame(spark, [(i, "ab"[i % 2], f"{REFERENCES[i % 3]}{i * 37 % 11}号機") for i in range(40)])
    right = frame(spark, [(i, "ab"[i % 2], f"{REFERENCES[(i + 1) % 3]}{i * 53 % 13}号機") for i in range(30)])
    whole = [sorted(map(tuple, f(left, right).collect())) for f in (overlaps, cosines)]
    monkeypatch.setattr(similarity, "CANDIDATES", 3)
    monkeypatch.setattr(similarity, "REFERENCES", 2)
    for f, expected in zip((overlaps, cosines), whole):
        got = sorted(map(tuple, f(left, right).collect()))
        assert [i for i, _ in got] == [i for i, _ in expected]
        assert [v for _, v in got] == pytest.approx([v for _, v in expected], abs=1e-9)


def test_null_categories_and_empty_tables(spark):
    left = frame(spark, [(1, None, "abcdef"), (2, "c", "abcdef")])
    for f, name in ((overlaps, "overlap"), (cosines, "cosine")):
        assert {r["id"]: r[name] for r in f(left, frame(spark, [(1, None, "abcdef")])).collect()} == {1: 0.0, 2: 0.0}
        assert f(frame(spark, []), left).count() == 0


def test_one_long_text(spark):
    long = "".join(chr(0x4E00 + i * 7919 % 9000) for i in range(60_000))
    assert overlaps(frame(spark, [(1, "c", long)]), frame(spark, [(1, "c", "前" + long)])).first()["overlap"] == 1.0


def shuffled(spark, f):
    """Bytes that ``f`` shuffles."""
    context = spark.sparkContext
    store, none = context._jsc.sc().statusStore(), context._gateway.new_array(context._jvm.double, 0)

    def total():
        context._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        stages = store.stageList(None, False, False, none, context._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    f()
    return total() - before


@pytest.mark.parametrize("measure", [overlaps, cosines])
def test_no_row_is_shuffled_for_each_block_of_the_other_side(spark, measure):
    """F1 to F6: with eight times the rows about eight times as much is shuffled, not the product of both sides."""

    def made(n):
        texts = lambda salt: frame(spark, [(i, "c", "".join(chr(0x4E00 + (i * 31 + k * 7919 + salt) ** 2 % 9000) for k in range(150))) for i in range(n)])
        return shuffled(spark, lambda: measure(texts(0), texts(5)).collect())

    assert made(2400) < 12 * made(300)


@pytest.mark.parametrize("measure", [overlaps, cosines])
def test_texts_are_shuffled_once(spark, measure):
    """every text is moved once, to its block, and not by its category before, nor with its grams."""
    texts = lambda salt: frame(spark, [(i, f"c{i % 5}", "".join(chr(0x4E00 + (i * 31 + k * 7919 + salt) ** 2 % 9000) for k in range(400))) for i in range(1500)])
    left, right = texts(0), texts(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        moved = shuffled(spark, lambda: left.unionAll(right).repartition(4, "id").select("id", "text", "category").write.format("noop").mode("overwrite").save())
        assert shuffled(spark, lambda: measure(left, right).collect()) < 1.3 * moved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("measure", [overlaps, cosines])
def test_repeated_rows_count_once(spark, measure):
    left, right = [(i, "ab"[i % 2], REFERENCES[i % 3]) for i in range(6)], [(i, "ab"[i % 2], REFERENCES[(i + 1) % 4] + "号機") for i in range(8)]
    rows = lambda times: sorted(map(tuple, measure(frame(spark, left * times), frame(spark, right * times)).collect()))
    assert rows(30) == rows(1)


def test_parts_of_frequencies_equal_the_whole(spark, monkeypatch):
    """the frequencies of a category, counted over many blocks and read in parts, give the same cosines."""
    from tsumugi.operators import similarity

    one = "".join(chr(0x4E00 + k * 7919 % 9000) for k in range(3000))
    left, right = frame(spark, [(i, "c", one[i * 5 :]) for i in range(3)]), frame(spark, [(i, "c", one[i:]) for i in range(60)])
    whole = sorted(map(tuple, cosines(left, right).collect()))
    monkeypatch.setattr(similarity, "REFERENCES", 6000)
    monkeypatch.setattr(similarity, "CELLS", 1000)
    found = sorted(map(tuple, cosines(left, right).collect()))
    assert [v for _, v in found] == pytest.approx([v for _, v in whole], abs=1e-9)
