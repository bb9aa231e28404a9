import random

import numpy as np
import pytest

from tsumugi.llm import leaks
from tsumugi.llm.leaks import bare, common_length, places

WORDS = "増資 計画 委員会 見通し 工場 設備 更新 価格 改定 見送り 採用 拡大 費用 負担 割合 進め方 手順書 達成度 公表 質問".split()


def sentence(rng, n):
    return "".join(rng.choice(WORDS) + rng.choice("はをがの") + str(rng.randrange(10_000)) for _ in range(n)) + "。"


def brute(documents, items):
    out, index = set(), {}
    for i, t in items:
        b = bare(t or "")
        for k in range(len(b) - 39):
            index.setdefault(b[k : k + 40], set()).add(i)
    for d, t in documents:
        b = bare(t or "")
        for k in range(len(b) - 39):
            out |= {(d, i) for i in index.get(b[k : k + 40], ())}
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    items = [(9000 + 3 * i, sentence(rng, 9)) for i in range(30)] + [(9990, None), (9991, ""), (9992, "短い")]
    documents = []
    for d in range(120):
        text = "".join(sentence(rng, rng.randrange(3, 9)) for _ in range(rng.randrange(1, 12)))
        if d % 4 == 0:
            item = items[d % 30][1]
            part = item[rng.randrange(8) :] if d % 8 else item[: 60 + d % 7]
            part = {0: part, 1: part.upper(), 2: "\n".join(part), 3: part.translate({ord(str(k)): chr(0xFF10 + k) for k in range(10)})}[d // 4 % 4]
            at = rng.randrange(len(text))
            text = text[:at] + part + text[at:]
        documents.append((d, text))
    return documents + [(500, None), (501, ""), (502, "。、！"), (503, items[0][1] * 900)], items


@pytest.mark.parametrize("partitions,block", [(1, 2000), (3, 7)])
def test_all_verbatim_leaks_are_found(spark, monkeypatch, data, partitions, block):
    documents, items = data
    monkeypatch.setattr(leaks, "ITEM_BLOCK", block)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in documents + documents[:5]], "doc_id bigint, text string, item string, doc int").repartition(partitions)
    listed = spark.createDataFrame([(i, t, "y") for i, t in items + items[:2]], "item_id bigint, text string, doc string")
    found = leaks.leaks(df, "doc_id", "text", listed, "item_id", "text").collect()
    assert {(r["doc"], r["item"]) for r in found if r["verbatim"]} == brute(documents, items)
    assert len({(r["doc"], r["item"]) for r in found}) == len(found)


def test_short_verbatim_leaks_are_found_wherever_they_lie(spark):
    """Stretches of exactly 40 to 60 characters, of rare terms within frequent ones, also across blocks."""
    rng = random.Random(12)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    phrases = [text(6) for _ in range(12)]
    items = [(i, "".join(rng.choice(phrases) for _ in range(12)) + text(72)) for i in range(420)]
    documents = []
    for d, (_, item) in enumerate(items):
        n, other = 40 + d // 20, "".join(rng.choice(phrases) for _ in range(24))
        at, start = rng.randrange(len(other)), 72 + rng.randrange(72 - n + 1)
        documents.append((d, other[:at] + item[start : start + n] + other[at:]))
    found = leaks.leaks(spark.createDataFrame(documents, "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text").where("verbatim").collect()
    assert {(r["doc"], r["item"]) for r in found} == brute(documents, items) and len(found) >= 420


def test_reworded_item(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, 8)) for i in range(20)]
    words = items[3][1]
    reworded = "".join(c + ("ね" if k % 17 == 16 else "") for k, c in enumerate(words))
    df = spark.createDataFrame([(1, reworded), (2, sentence(rng, 8))], "doc_id bigint, text string")
    found = leaks.leaks(df, "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text").collect()
    assert [(r["doc"], r["item"], r["verbatim"]) for r in found] == [(1, 3, False)] and found[0]["lcs_share"] > 0.95


@pytest.mark.parametrize("length", [60, 300, 1000])
def test_reworded_items_of_any_length(spark, length):
    """Also a part of a long item that is reworded, within a long document."""
    rng = random.Random(length)
    items = [(i, sentence(rng, length // 8 + 2)[:length]) for i in range(12)]
    reword = lambda t: "".join(c + ("ね" if k % 23 == 22 else "") for k, c in enumerate(t))
    around = lambda: "".join(sentence(rng, 5) for _ in range(20))
    documents = [(i, around() + reword(t) + around()) for i, t in items] + [(100 + i, around() + reword(t[length // 3 : length // 3 + 260]) + around()) for i, t in items if length > 600] + [(200, around())]
    found = leaks.leaks(spark.createDataFrame(documents, "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text").collect()
    assert {(r["doc"], r["item"]) for r in found} == {(d, d % 100) for d, _ in documents if d < 200}
    assert not any(r["verbatim"] for r in found)


def test_pieces_cover_items():
    for n in (0, 1, 160, 161, 240, 1000):
        pieces = leaks.pieces_of(n)
        assert pieces[0][0] == 0 and pieces[-1][1] == n and all(b - a == min(n, leaks.PIECE) for a, b in pieces)
        assert all(0 < c - a <= leaks.PIECE // 2 for (a, _), (c, _) in zip(pieces, pieces[1:]))


def test_nothing_to_compare(spark, data):
    docs, items = (spark.createDataFrame(x, s) for x, s in zip(data, ("doc_id bigint, text string", "item_id bigint, text string")))
    assert leaks.leaks(docs.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0
    assert leaks.leaks(docs, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0


def test_bare():
    assert bare("Ａb　Ｃ－１２３！é ½㈱") == "abc123é12株"


def test_lcs():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 20))) for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert common_length(places(a), len(a), b) == t[-1, -1]
