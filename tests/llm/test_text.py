import pytest

from tsumugi.llm.text import chosen, plain, repairs, same_looking_pairs, settle, skeleton, unify


@pytest.mark.parametrize("a,b", [("ＡＢＣ１", "ABC1"), ("ｶﾞｷﾞ", "ガギ"), ("が", "が"), ("a​b⁠­", "ab"), ("a  \n　b ", "a b"), ("a‐b－c―d", "a-b-c-d"), ("⽇⽉", "日月"), ("é", "é"), ("葛󠄀", "葛"), ("​ ​", ""), ("㈱", "(株)")])
def test_plain(a, b):
    assert plain(a) == plain(b) == b


@pytest.mark.parametrize("a,b", [("ТОР", "TOP"), ("Сafé", "Café"), ("マ八ネヌ", "マハネヌ"), ("ポミ二エ", "ポミニエ"), ("モ口セイ", "モロセイ"), ("へ", "ヘ"), ("ΝΟVΑ", "NOVA"), ("デ一タ", "データ")])
def test_skeleton_joins_shapes(a, b):
    assert a != b and skeleton(plain(a)) == skeleton(plain(b))


@pytest.mark.parametrize("a,b", [("abc", "Abc"), ("ハ", "バ"), ("ソ", "ン"), ("シ", "ツ"), ("O", "0"), ("あ", "ぁ"), ("a b", "ab"), ("、", "，")])
def test_skeleton_keeps_what_differs(a, b):
    assert skeleton(plain(a)) != skeleton(plain(b))


def test_only_mixed_tokens_are_repaired():
    assert repairs("NОVA") == ("NOVA",) and repairs("NOVA") == () and repairs("ТОР") == ()
    assert repairs("マ八ネ") == ("マハネ",) and repairs("工場") == () and repairs("八") == ()


@pytest.mark.parametrize("tokens,form", [(("ポイン卜動", "ポイント動"), "ポイント動"), (("オヘベ包装箱", "オへベ包装箱"), "オヘベ包装箱"), (("オロオココ工業", "オ口才ココエ業"), "オロオココ工業")])
def test_look_alikes_between_scripts(tokens, form):
    known = {p: 2 for p in ("ポイント", "動", "オヘベ", "包装箱", "オロオココ", "工業")} | {"オ": 9, "ベ": 9, "ヘベ": 1, "才": 5}
    assert {chosen(repairs(t), known) for t in tokens} == {form} and chosen(repairs(tokens[0]), {}) is None


def test_the_corpus_decides(spark):
    """Pairs come from repaired forms; only where the corpus has no form of a token does the shape decide."""
    titles = ["9ポイント動いた", "9ポイン卜動いた", "ポイントの動き", "ネヘツ薬品", "ネへツ薬品", "xОy", "xoy", "хOу", "ТОР", "TOP"]
    made = unify(spark.createDataFrame([(i, t, None, "x", "y") for i, t in enumerate(titles)], SCHEMA), "row_id", ["title"])
    assert {tuple(r) for r in same_looking_pairs(made).collect()} == {("title", 0, 1, "repair"), ("title", 3, 4, "repair"), ("title", 5, 7, "shape"), ("title", 8, 9, "shape")}


SCHEMA = "row_id bigint, title string, body string, id string, look string"


@pytest.mark.parametrize("partitions", [1, 4])
def test_unify(spark, partitions):
    titles = ["ＮОVA‐806", "NOVA-806", "NOVA-806", "nova-806", "Пошта ТОР", "マ八ネ工業", "マハネ工業", None, "", " ​", "xОy"]
    rows = [(i, t, "b" * 20_000 if i == 2 else None, "x", "y") for i, t in enumerate(titles)]
    made = unify(spark.createDataFrame(rows + rows[:3], SCHEMA).repartition(partitions), "row_id", ["title", "body"])
    got = {(r["id"], r["field"]): r["unified"] for r in settle(made).collect()}
    assert got == {(0, "title"): "NOVA-806", (1, "title"): "NOVA-806", (2, "title"): "NOVA-806", (3, "title"): "nova-806", (4, "title"): "Пошта ТОР", (5, "title"): "マハネ工業", (6, "title"): "マハネ工業", (10, "title"): "xОy", (2, "body"): "b" * 20_000}
    pairs = {tuple(r)[:3] for r in same_looking_pairs(made).collect()}
    assert pairs == {("title", 0, 1), ("title", 0, 2), ("title", 5, 6)}


def test_settle_gives_one_form_to_each_look(spark):
    rows = [(i, "TОР-1" if i < 2 else "ТОР-1", None, "x", "y") for i in range(5)]
    forms = settle(unify(spark.createDataFrame(rows, SCHEMA), "row_id", ["title"])).select("unified").distinct().collect()
    assert len(forms) == 1


def test_no_rows(spark):
    made = unify(spark.createDataFrame([], SCHEMA), "row_id", ["title", "body"])
    assert made.count() == settle(made).count() == same_looking_pairs(made).count() == 0
