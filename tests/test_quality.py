import pytest
from pyspark.sql import functions as F

from tsumugi.config import Config
from tsumugi.functions import text as T
from tsumugi.operators import quality


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("text,problem", [("", "terminator"), ("。。。", None), ("あ。" * 20, "sentences"), ("あ" * 150 + ".", None), ("あ" * 201 + "。", "sentences"), ("新工場の建設を発表した。" * 10, None), ("ABC社は新工場を発表", "terminator"), ("abc。", "script")])
def test_language(spark, text, problem):
    assert value(spark, text, quality.language_problem) == problem


@pytest.mark.parametrize("text,problem", [("x https://a.example/x", "url"), ("http:// 空白", None), ("〒123-4567", "postal"), ("〒１２３-４５６７", "postal"), ("電話は03-1234-5678", "phone"), ("電話\n03-1234-5678", None), ("03-1234-5678", None), ("2024年5月1日", None)])
def test_safety(spark, text, problem):
    assert value(spark, text, quality.safety_problem) == problem


def test_length_tests_the_title_first(spark):
    rows = [("t", "b" * 120, 2, 5, 120, 600), ("tt", "b", 2, 5, 120, 600), ("t", "b" * 120, None, None, 120, 600), ("t", "b" * 601, None, None, None, None)]
    df = spark.createDataFrame(rows, "t string, b string, a int, z int, x int, y int")
    found = [r[0] for r in df.select(quality.length_problem(*[F.col(c) for c in "tbazxy"])).collect()]
    assert found == ["title", "body", None, "body"]


def test_text_functions(spark):
    assert value(spark, "　 a　", T.strip) == "a"
    assert value(spark, "あa漢ｱ한　", lambda c: T.matches(c, r"[\x{3000}-\x{9FFF}]")) == 3
    assert value(spark, "1２³④x", lambda c: T.matches(c, T.digit_class())) == 4
    assert value(spark, "😀あい", lambda c: T.grams(c, 2)) == ["😀あ", "あい"]
    assert value(spark, "a", lambda c: T.grams(c, 2)) == []
    assert value(spark, None, lambda c: T.grams(c, 2)) is None or value(spark, None, lambda c: T.grams(c, 2)) == []
    assert value(spark, "あ。い。", T.sentences) == ["あ", "い"]


SAMPLES = "id bigint, category string, style string, title string, body string, model_category string, extra int"
GOOD = "".join(f"{c}社は新しい工場の建設を発表した。" for c in "甲乙丙丁戊己庚辛壬癸")


def validated(spark, rows, references, config=Config()):
    styles = spark.createDataFrame([(0, "s", None, None, None, None, 120, 600)], "pos int, name string, description string, tone string, title_min int, title_max int, body_min int, body_max int")
    done = quality.validate(spark.createDataFrame(rows, SAMPLES), spark.createDataFrame(references, "id bigint, category string, text string"), styles, config)
    return {r["id"]: r for r in done.collect()}


def test_validate_gives_all_reasons_in_order(spark):
    bad = "https://x.y " + GOOD[:20]
    rows = [(1, "a", "s", "題", GOOD, "a", 0), (2, "a", "s", None, GOOD, "a", 0), (3, "a", "s", "〒123-4567", bad, "a", 0), (4, "債権譲渡", "s", "題", GOOD, "債権譲渡", 0), (5, None, "s", "題", GOOD, None, 0), (6, "a", "other", "題", GOOD, "a", 0)]
    v = validated(spark, rows, [(1, "a", GOOD), (2, "債権譲渡", GOOD)])
    assert v[1]["reasons"] == ["cosine", "ngram"] and v[1]["metrics"]["max_overlap"] == 1.0 and not v[1]["passed"]
    assert v[2]["reasons"] == ["malformed"]
    assert v[3]["reasons"][0] == "length" and v[3]["reasons"][-2:] == ["title_safety", "body_safety"]
    assert v[4]["passed"] and v[4]["metrics"] == {"max_cosine": 0.0, "max_overlap": 0.0}
    assert v[5]["passed"] and v[6]["reasons"] == ["length", "cosine", "ngram"]
    assert v[1]["extra"] == 0


def test_validate_empty(spark):
    assert validated(spark, [], []) == {}


def test_similarity_is_skipped_by_the_category_the_model_reports(spark):
    """Not by the one asked for: of two copies of a reference only that reported as of a skipped category passes."""
    text = "".join(f"第{k}区の案は{k * 7}件の意見を受けて改めた。" for k in range(9))
    rows = [(1, "設備", "速報", "題名は十文字以上あります", text, "設備"), (2, "設備", "速報", "題名は十文字以上あります", text, "債権譲渡"), (3, "債権譲渡", "速報", "題名は十文字以上あります", text, "設備")]
    df = spark.createDataFrame(rows, "id bigint, category string, style string, title string, body string, model_category string")
    refs = spark.createDataFrame([(7, "設備", text), (8, "債権譲渡", text)], "id bigint, category string, text string")
    styles = spark.createDataFrame([], "name string, title_min int, title_max int, body_min int, body_max int")
    got = {r["id"]: r["reasons"] for r in quality.validate(df, refs, styles).collect()}
    assert got == {1: ["cosine", "ngram"], 2: [], 3: ["cosine", "ngram"]}
