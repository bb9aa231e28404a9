import random

import pytest

from tsumugi.llm import common, history, near
from tsumugi.llm.shingles import grams_of, jaccard, verified


def bodies(seed, n=60):
    rng = random.Random(seed)
    make = lambda: "".join(rng.choice("日月火水木金土山川田空海東西南北春夏秋冬") for _ in range(200))
    out = [make() for _ in range(n)]
    for k in range(0, 30):
        base = out[k // 5]
        at = rng.randrange(150)
        out.append({0: base, 1: base[:at] + "変" + base[at:], 2: base[100:] + base[:100], 3: f" {base[:50]}\n　{base[50:]}", 4: base[:at] + base[at + 9 :]}[k % 5])
    return [*out, None, "", "短い" * 20, "同" * 119, "同" * 120, "同" * 500, out[0]]


def brute(texts):
    sets = [grams_of(t) if t and len(t) >= 120 else None for t in texts]
    return {(i, j) for j in range(len(sets)) for i in range(j) if sets[i] is not None and sets[j] is not None and jaccard(sets[i], sets[j]) >= 0.7}


@pytest.mark.parametrize("partitions,boundary", [(1, 1000), (4, 3)])
def test_pairs_equal_brute_force(spark, monkeypatch, partitions, boundary):
    texts = bodies(1)
    monkeypatch.setattr(near, "LEAST_BOUNDARY", boundary)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "id bigint, text string, a string").repartition(partitions)
    members, pairs = near.near_duplicates(df.select("id", "text", "a"))
    got = {tuple(sorted((r["a"], r["b"]))) for r in near.expanded(members, pairs).collect()}
    assert got == brute(texts)
    group = {r["id"]: r["group_id"] for r in near.components(members, pairs).collect()}
    label = list(range(len(texts)))
    for _ in texts:
        for i, j in got:
            label[i] = label[j] = min(label[i], label[j])
    assert group == {i: label[i] for i in group} and set(group) == {i for i, t in enumerate(texts) if t and len(t) >= 120}


def test_long_lists_are_scanned_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "LEAST_BOUNDARY", 2)
    spark.conf.set("spark.sql.shuffle.partitions", 4000)  # makes the boundary the least one
    try:
        base = bodies(3)[0]
        texts = [f"{base}{i:03}" for i in range(25)]
        classes = near.signed(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").coalesce(1))
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        pairs = near.class_pairs(near.stage(classes, "classes"))
        assert {(r["a"], r["b"]) for r in pairs.collect()} == {(i, j) for j in range(25) for i in range(j)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_a_long_chain_is_one_group(spark):
    members = spark.createDataFrame([(i, i) for i in range(40)], "id bigint, rep bigint")
    pairs = spark.createDataFrame([(i, i + 1, 0.9) for i in range(39)], "a bigint, b bigint, similarity double")
    assert {r["group_id"] for r in near.components(members, pairs).collect()} == {0}


def test_no_bodies(spark):
    members, pairs = near.near_duplicates(spark.createDataFrame([(1, None)], "id bigint, text string"))
    assert members.count() == pairs.count() == near.components(members, pairs).count() == 0


@pytest.fixture(scope="module")
def barely_similar():
    """Pairs of bodies with a Jaccard just above the limit."""
    rng = random.Random(13)
    text = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    out = []
    for _ in range(1500):
        base, at = text(280), rng.randrange(20, 200)
        out += [base, base[:at] + text(44) + base[at + 44 :]]
    assert all(0.70 < jaccard(grams_of(a), grams_of(b)) < 0.71 for a, b in zip(out[::2], out[1::2]))
    return out


def test_no_barely_similar_pair_is_missed(spark, barely_similar):
    pairs = near.near_duplicates(spark.createDataFrame(list(enumerate(barely_similar)), "id bigint, text string"))[1]
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {(i, i + 1) for i in range(0, len(barely_similar), 2)}


def test_no_barely_similar_repeat_is_missed(spark, barely_similar):
    df = spark.createDataFrame([(i, i % 2, "a", t) for i, t in enumerate(barely_similar)], "id bigint, load int, category string, text string")
    found = history.repeats(df, "id", "load", "category", "text", buckets=4).collect()
    assert {(r["id"], r["first_id"]) for r in found} == {(i + 1, i) for i in range(0, len(barely_similar), 2)}


def test_verified_uses_exact_sets(spark):
    texts = bodies(2)[:8]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (3, 3)], "a bigint, b bigint")
    assert {(r["a"], r["b"]) for r in verified(pairs, df).collect()} == {p for p in [(0, 1), (0, 2), (3, 3)] if jaccard(grams_of(texts[p[0]]), grams_of(texts[p[1]])) >= 0.7}


@pytest.mark.parametrize("buckets,tile,rows", [(4, 1024, 10**6), (3, 2, 0)])
def test_repeats_of_earlier_loads(spark, monkeypatch, buckets, tile, rows):
    monkeypatch.setattr(history, "TILE", tile)
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    rng = random.Random(7)
    texts = bodies(5, 30)
    rows = [(i, rng.randrange(5), rng.choice(["a", "a", None]), t, "x", "y") for i, t in enumerate(texts * 2)]
    pairs = brute([r[3] for r in rows])
    expected = {x[0] for i, j in pairs for x, y in ((rows[i], rows[j]), (rows[j], rows[i])) if x[2] is not None and x[2] == y[2] and y[1] < x[1]}
    df = spark.createDataFrame(rows + rows[:9], "aug_id bigint, load_no int, category string, body string, id string, load string")
    found = history.repeats(df, "aug_id", "load_no", "category", "body", buckets=buckets).collect()
    assert {r["id"] for r in found} == expected and len(found) == len(expected)
    load = {r[0]: r[1] for r in rows}
    assert all(load[r["first_id"]] < load[r["id"]] for r in found)


def test_an_index_opened_again_knows_its_history(spark, tmp_path):
    texts = bodies(6, 8)
    rows = [(i, i // 20, "a", t) for i, t in enumerate([*texts, texts[0], texts[9][:-3] + "終わり"])]
    df = spark.createDataFrame(rows, "id bigint, load int, category string, text string")
    folder, found = f"file://{tmp_path}/index", []
    for load in range(3):
        index = history.History(spark, buckets=3, folder=folder)
        found += [r["id"] for r in index.take(df.where(df["load"] == load), load).collect()]
        index.close()
    assert sorted(found) == sorted(r["id"] for r in history.repeats(df, "id", "load", "category", "text", buckets=3).collect())
    assert len(texts) in found


def test_history_of_nothing(spark):
    df = spark.createDataFrame([], "aug_id bigint, load_no int, category string, body string")
    assert history.repeats(df, "aug_id", "load_no", "category", "body").count() == 0
    df = spark.createDataFrame([(1, 0, None, None), (2, 1, "a", "")], "aug_id bigint, load_no int, category string, body string")
    assert history.repeats(df, "aug_id", "load_no", "category", "body").count() == 0


def test_a_delivery_that_failed_halfway_is_taken_again_as_a_whole(spark, tmp_path, monkeypatch):
    texts = bodies(8, 3)[:3]
    near = texts[1][:90] + "変" + texts[1][90:]
    rows = [(0, 0, "a", texts[0]), (1, 1, "a", texts[1]), (2, 2, "a", near), (3, 2, "b", near), (4, 2, "a", texts[1])]
    df = spark.createDataFrame(rows, "id bigint, load int, category string, text string")
    index = history.History(spark, buckets=3, folder=f"file://{tmp_path}/index")
    of = lambda load: df.where(df["load"] == load)
    assert index.take(of(0), 0).count() == 0
    monkeypatch.setattr(history, "mark", lambda *_: 1 / 0)  # all is written, but it never becomes part of the history
    with pytest.raises(ZeroDivisionError):
        index.take(of(1), 1)
    monkeypatch.undo()
    assert [*index.taken()] == [0]
    assert index.take(of(1), 1).count() == 0
    first = sorted(index.take(of(2), 2).collect())
    assert [(r["id"], r["first_id"]) for r in first] == [(2, 1), (4, 1)]
    assert sorted(index.take(of(2), 2).collect()) == first  # taken before
    index.close()


def test_a_large_group_of_near_copies_meets_its_first_only(spark):
    base = bodies(9, 1)[0]
    rows = [(i, i // 100, "a", base[:i] + "変" + base[i:]) for i in range(200)] + [(999, 1, "a", bodies(10, 1)[0])]
    df = spark.createDataFrame(rows, "id bigint, load int, category string, text string")
    found = history.repeats(df, "id", "load", "category", "text", buckets=2)
    assert {r["id"] for r in found.collect()} == set(range(100, 200))


def test_only_plausible_pairs_leave_a_bucket(spark, monkeypatch):
    base, other = bodies(11, 2)[:2]
    texts = [base[:80] + bodies(100 + k, 1)[0][:120] for k in range(40)]
    assert not brute(texts) and all(jaccard(grams_of(texts[0]), grams_of(t)) > 0.2 for t in texts)
    rows = [(i, i // 20, "a", t) for i, t in enumerate(texts)] + [(90, 0, "a", other), (91, 1, "a", other[:90] + "変" + other[90:])]
    staged = []
    monkeypatch.setattr(history, "stage", lambda df, name, *under: staged.append((name, x := common.stage(df, name, *under), x.count())) or x)
    found = history.repeats(spark.createDataFrame(rows, "id bigint, load int, category string, text string"), "id", "load", "category", "text", buckets=2)
    assert {(r["id"], r["first_id"]) for r in found.collect()} == {(91, 90)}
    assert {n for name, _, n in staged if name == "close"} == {1} and all(n <= 2 for name, _, n in staged if name == "met")


@pytest.mark.parametrize("crossed,light,step", [(256, 4, 1 << 17), (256, 4, 7), (256, 0, 7), (0, 0, 1 << 17)])
def test_repeats_whatever_lists_are_short(spark, monkeypatch, crossed, light, step):
    for name, value in (("CROSSED", crossed), ("LIGHT", light), ("STEP", step), ("TILE", 3)):
        monkeypatch.setattr(history, name, value)
    texts = bodies(12, 12)
    group = [texts[0][:i] + "変" + texts[0][i:] for i in range(0, 80, 4)]
    shared = [texts[1][:120] + t[:90] for t in texts[2:12]]
    rows = [(i, i % 3, "a", t) for i, t in enumerate([*texts, *group, *shared])]
    expected = {y[0] for i, j in brute([r[3] for r in rows]) for x, y in ((rows[i], rows[j]), (rows[j], rows[i])) if x[1] < y[1]}
    found = history.repeats(spark.createDataFrame(rows, "id bigint, load int, category string, text string"), "id", "load", "category", "text", buckets=2).collect()
    assert {r["id"] for r in found} == expected and len(found) == len(expected)
