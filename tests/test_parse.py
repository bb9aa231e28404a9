import json

import pytest

from tsumugi.operators import parse

ONE = '[{"title":"a"}]'


@pytest.mark.parametrize("content,n", [(ONE, 1), (f"```json\n{ONE}\n```", 1), (f"Here: {ONE} done", 1), ('{"title":"a"}', 1), ('{"items":[{"title":"a"}]}', 1), (f"{ONE} tail", 0), ("x [1] y [2] z", 0), ("plain", 0), ("", 0), (None, 0), ("[]", 0), ('["a"]', 1), ("{broken", 0), ("5", 0)])
def test_parse(content, n):
    assert len(parse.parse_answer(content)) == n


def test_candidates(spark):
    item = {"title": "t", "body": "b", "category": "c", "style": "s", "n": 3, "tags": ["x"]}
    rows = [("c", "s", 0, 0, json.dumps([item] * 5, ensure_ascii=False)), ("c", "s", 0, 1, '["a"]'), ("c", "s", 0, 2, None), ("c", "s", 0, 3, '{"title": 5, "body": "b"}')]
    got = parse.candidates(spark.createDataFrame(rows, "category string, style string, round int, batch_idx int, content string")).orderBy("batch_idx", "sample_idx").collect()
    assert [(r["batch_idx"], r["sample_idx"], r["malformed"]) for r in got] == [(0, 0, False), (0, 1, False), (0, 2, False), (1, 0, True), (3, 0, True)]
    assert got[0]["extras"] == {"n": "3", "tags": '["x"]'} and got[0]["model_category"] == "c"
    assert got[4]["title"] is None and got[4]["body"] == "b"
